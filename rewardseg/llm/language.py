"""Language identification with a linear-chain conditional random field.

Words are runs of letters; a chain is a run of words without a sentence or
line end between them.  A word's emission score per language is the sum of
learned weights of its hashed character n-grams over ``^word$`` (those that
touch ``^`` or ``$`` are its prefixes and suffixes) and of a lexicon feature,
the centred log-frequency of the word in each language.  Learned transitions
link neighbouring words, so code-switched text is labelled word by word:
forward-backward gives every word's posterior, and a document's language is
the one with the largest posterior mass.

The lexicon counts every word of every training document; the weights are
fitted by gradient steps on the chain likelihood over a bounded sample
(``SAMPLE`` documents per language, by hash, and of a longer one a passage of
``SAMPLE_CHARS`` at a place by hash).  Every label is learned: the driver's
arrays grow with the number of languages, by about 1.5 MB each.

Everything inside a task is arrays over code points: a word is known by a
64-bit hash of its lower-cased letters.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
a null doc_id is never trained on and counts as held out; rows sharing a
doc_id are labelled one by one; without training rows every text is ``und``;
other columns are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from rewardseg.llm.common import byte_sizes, fresh_name, kept, slices, table

LEXICON_BITS, GRAM_BITS = 15, 16
GRAMS = (2, 3, 4)
SAMPLE, SAMPLE_CHARS = 150, 20_000
EPOCHS, BATCH_CHAINS, STEP = 6, 600, 0.4
FOLDS = 3
SLICE_BYTES = 2_000_000
SENTENCE_END = ".!?\n"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """(is a letter, its lower case) per code point (kept between tasks)."""
    return kept("letters", _letter_tables)


def _letter_tables() -> tuple[np.ndarray, np.ndarray]:
    points = range(sys.maxunicode + 1)
    letter = np.fromiter((chr(c).isalpha() for c in points), bool, len(points))
    lower = np.arange(len(points), dtype=np.uint32)
    for c in np.flatnonzero(letter):
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
    return letter, lower


class Words:
    """The words of a few texts: distinct words, where each occurs, its text
    and where chains begin."""

    def __init__(self, texts: list[str]):
        letter, lower = letter_tables()
        parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        points = np.concatenate([*parts, np.zeros(1, np.uint32)])
        text_ends = np.cumsum([len(p) for p in parts]) if parts else np.zeros(0, np.int64)
        is_letter = letter[points]
        # a text boundary also ends a word
        before = np.concatenate([[False], is_letter[:-1]])
        inner = text_ends[:-1][text_ends[:-1] < len(points)] if len(text_ends) else np.zeros(0, np.int64)
        before[inner] = False
        starts = np.flatnonzero(is_letter & ~before)
        after = np.concatenate([is_letter[1:], [False]])
        after[inner[inner > 0] - 1] = False
        ends = np.flatnonzero(is_letter & ~after) + 1
        self.n = len(starts)
        self.text = np.searchsorted(text_ends, starts, "right")
        if not self.n:
            return
        low = lower[points].astype(np.uint64)
        place = np.arange(len(points), dtype=np.uint64)
        place[starts[0]:] -= np.repeat(starts, np.diff(starts, append=len(points))).astype(np.uint64)
        value = np.where(is_letter, (low + np.uint64(1)) * (_MIX * (place * np.uint64(2) + np.uint64(1))), np.uint64(0))
        value ^= value >> np.uint64(29)
        hashes = np.add.reduceat(value, starts) * _MIX
        self.hashes, first, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        # the distinct words' letters with ^ and $ around them, end to end
        size = (ends - starts)[first]
        self.size = size + 2
        self.at = np.cumsum(self.size) - self.size
        self.letters = np.full(int(self.size.sum()), 1, np.uint64)
        take = np.repeat(starts[first] - np.cumsum(size) + size, size) + np.arange(size.sum())
        put = np.repeat(self.at + 1 - np.cumsum(size) + size, size) + np.arange(size.sum())
        self.letters[put] = low[take]
        self.letters[self.at + self.size - 1] = 2
        breaks = np.cumsum(np.isin(points, [ord(c) for c in SENTENCE_END]))
        opens = np.ones(self.n, bool)
        opens[1:] = (self.text[1:] != self.text[:-1]) | (breaks[starts[1:]] != breaks[ends[:-1] - 1])
        self.chain_starts = np.flatnonzero(opens)

    def lexicon(self) -> np.ndarray:
        return (self.hashes >> np.uint64(64 - LEXICON_BITS)).astype(np.int64)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct word, hashed n-gram) of all its n-grams, ordered by word within each n."""
        owner = np.repeat(np.arange(len(self.size)), self.size)
        words, grams = [], []
        for n in GRAMS:
            if len(self.letters) < n:
                continue
            key = np.full(len(self.letters) - n + 1, n, np.uint64)
            for i in range(n):
                key = key * np.uint64(1_000_003) + self.letters[i:len(self.letters) - n + 1 + i]
            whole = np.flatnonzero(owner[: len(key)] == owner[n - 1:])
            words.append(owner[whole])
            grams.append(((key[whole] * _MIX) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
        return np.concatenate(words), np.concatenate(grams)


class Model:
    def __init__(self, languages: list[str], lexicon: np.ndarray):
        k = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.weights = np.zeros((1 << GRAM_BITS, k))
        self.lexicon_weight = 0.5
        self.transitions = np.eye(k)

    def emissions(self, words: Words, grams) -> np.ndarray:
        """Scores of the distinct words per language."""
        of, gram = grams
        out = np.stack([np.bincount(of, self.weights[gram, k], len(words.size)) for k in range(len(self.languages))], 1)
        # long words have more n-grams than short ones, not more evidence
        return out / np.sqrt(words.size)[:, None] + self.lexicon_weight * self.lexicon[words.lexicon()]

    def posteriors(self, emissions: np.ndarray, words: Words):
        """(posterior per word, sum over neighbours of pair posteriors) by
        scaled forward-backward over all chains in lockstep."""
        k = len(self.languages)
        score = emissions[words.word]
        e = np.exp(score - score.max(1, keepdims=True))
        move = np.exp(self.transitions - self.transitions.max())
        sizes = np.diff(words.chain_starts, append=words.n)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = words.chain_starts[order], sizes[order]
        live = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")  # chains with more than t words
        forward = np.empty_like(e)
        a = e[starts] / k
        for t, n in enumerate(live):
            at = starts[:n] + t
            if t:
                a = (a[:n] @ move) * e[at]
            a = a / a.sum(1, keepdims=True)
            forward[at] = a
        backward = np.ones_like(e)
        pairs = np.zeros((k, k))
        b = np.ones((0, k))
        for t in range(len(live) - 1, 0, -1):
            n = live[t]
            at = starts[:n] + t
            b = np.concatenate([b, np.ones((n - len(b), k))])
            ahead = b * e[at]
            f = forward[at - 1]
            scale = np.einsum("ni,ij,nj->n", f, move, ahead)
            pairs += (f / scale[:, None]).T @ ahead * move
            b = ahead @ move.T
            b /= b.sum(1, keepdims=True)
            backward[at - 1] = b
        posterior = forward * backward
        return posterior / posterior.sum(1, keepdims=True), pairs


def fit(texts: list[str], labels: np.ndarray, languages: list[str], lexicon: np.ndarray, seed: int = 0) -> Model:
    """Adaptive gradient steps on the chains' conditional likelihood; every
    word of a training text carries the text's label."""
    model, rng = Model(languages, lexicon), np.random.default_rng(seed)
    k = len(languages)
    if k < 2 or not texts:
        return model
    seen, seen_t, seen_l = np.full(model.weights.shape, 1e-2), np.full((k, k), 1.0), 1.0
    batch = max(4, min(len(texts), BATCH_CHAINS // 20))
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            part = order[lo:lo + batch]
            words = Words([texts[i] for i in part])
            if not words.n:
                continue
            grams = words.grams()
            posterior, pairs = model.posteriors(model.emissions(words, grams), words)
            gold = labels[part][words.text]
            wrong = -posterior
            wrong[np.arange(words.n), gold] += 1.0
            per_word = np.stack([np.bincount(words.word, wrong[:, j], len(words.size)) for j in range(k)], 1)
            scaled = per_word / np.sqrt(words.size)[:, None]
            of, gram = grams
            used, where = np.unique(gram, return_inverse=True)
            g = np.stack([np.bincount(where, scaled[of, j], len(used)) for j in range(k)], 1) / words.n
            g -= 1e-6 * model.weights[used]
            seen[used] += g * g * 1e4
            model.weights[used] += STEP * 100 * g / np.sqrt(seen[used])
            follows = np.ones(words.n, bool)
            follows[words.chain_starts] = False
            gold_pairs = np.zeros((k, k))
            np.add.at(gold_pairs, (gold[follows], gold[follows]), 1.0)
            gt = (gold_pairs - pairs) / words.n - 1e-2 * model.transitions
            seen_t += gt * gt
            model.transitions += STEP * gt / np.sqrt(seen_t)
            gl = float((per_word * lexicon[words.lexicon()]).sum()) / words.n
            seen_l += gl * gl
            model.lexicon_weight = max(0.0, model.lexicon_weight + STEP * gl / np.sqrt(seen_l))
    return model


# -- on Spark ---------------------------------------------------------------

def held_out(column: str):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS == 1, F.lit(True))


def lexicon_counts(rows: DataFrame, languages: list[str]) -> DataFrame:
    """(language, bucket, n): word counts of all training texts, summed in
    each slice, each task and then over tasks."""
    number = {v: i for i, v in enumerate(languages)}

    def run(batches):
        for batch in batches:
            texts, langs = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in slices(byte_sizes(texts), SLICE_BYTES):
                words = Words([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                if words.n:
                    own = np.array([number[v] for v in langs[lo:hi]], np.int64)[words.text]
                    key, n = np.unique(own * (1 << LEXICON_BITS) + words.lexicon()[words.word], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key >> LEXICON_BITS, pa.int32()), pa.array(key & ((1 << LEXICON_BITS) - 1), pa.int32()),
                         pa.array(n, pa.int64())], ["language", "bucket", "n"])
    return rows.select("text", "lang").mapInArrow(run, "language int, bucket int, n long").groupBy(
        "language", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the text and lang of documents outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    worded = F.col("text").rlike("\\p{L}")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count_if(worded).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((1 << LEXICON_BITS, 0)))
    counts = lexicon_counts(rows, languages).toPandas()  # at most buckets x languages rows
    n = np.zeros((1 << LEXICON_BITS, len(languages)))
    n[counts["bucket"].to_numpy(int), counts["language"].to_numpy(int)] = counts["n"].to_numpy()
    share = np.log((n + 0.5) / (n.sum(0) + 0.5 * len(n)))
    lexicon = np.clip(share - share.mean(1, keepdims=True), -3, 3)
    key = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    ample = F.create_map(*[x for v in languages for x in (
        F.lit(v), F.lit(int(min(1.0, 3 * sample / max(1, sizes[v])) * (1 << 30))))])
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    start = F.pmod(F.xxhash64(F.lit(1), "doc_id"), spare + 1).cast("int") + 1
    first = Window.partitionBy("lang").orderBy("key", "doc_id")
    drawn = (rows.where(worded & (key < ample[F.col("lang")]))
             .select("lang", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("text"), key.alias("key"), "doc_id")
             .withColumn("place", F.row_number().over(first)).where(F.col("place") <= sample))
    rows_drawn = sorted(drawn.collect(), key=lambda r: (r["lang"], r["place"]))  # at most sample per language
    texts = [r["text"] for r in rows_drawn]
    number = {v: i for i, v in enumerate(languages)}
    labels = [number[r["lang"]] for r in rows_drawn]
    return fit(texts, np.array(labels, np.int64), languages, lexicon)


def predict(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` columns ``keep`` with the language and score of each whole text."""
    schema = docs.select(*keep).schema
    names_out = [*keep, *names]

    def label(texts: list[str]):
        pred, score = ["und"] * len(texts), np.zeros(len(texts))
        words = Words(texts)
        if words.n and model.languages:
            posterior, _ = model.posteriors(model.emissions(words, words.grams()), words)
            mass = np.stack([np.bincount(words.text, posterior[:, j], len(texts)) for j in range(len(model.languages))], 1)
            total = mass.sum(1)
            for i in np.flatnonzero(total > 0):
                best = int(np.argmax(mass[i]))
                pred[i], score[i] = model.languages[best], min(1.0, mass[i, best] / total[i])
        return pred, score

    def run(batches):
        for batch in batches:
            texts = batch.column(len(keep))
            for lo, hi in slices(byte_sizes(texts), SLICE_BYTES):
                pred, score = label([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in range(len(keep))),
                     pa.array(pred, pa.string()), pa.array(score, pa.float64())], names_out)
    return docs.select(*keep, F.col("text").cast("string").alias(fresh_name("text", keep))).mapInArrow(run, StructType(
        [*schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())]))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs), ["doc_id"]).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
