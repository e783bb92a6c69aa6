"""Quality classifier: Naive Bayes support vectors (NBSVM).

Features are indicators (present or not) of hashed n-grams of a text:
byte trigrams; six-grams of its character classes with runs collapsed, which
show the shape of a few words and their punctuation; and four-grams of "same
word as before" marks.  Each indicator is scaled by its class log-count
ratio, counted over every labelled training document.  A linear hinge-loss
model is then fitted by dual coordinate descent on a bounded sample of the
labelled documents (``SAMPLE`` per class, by hash), and its margins are
mapped to probabilities by a logistic fit on the same sample.

Defined cases: null text is the empty text, and texts without any feature
get the probability of the bias alone; a null doc_id is never trained on
and counts as held out; rows sharing a doc_id are scored one by one (several
labels of one doc_id train as their lowest); labels other than 0 and 1 are
ignored; without labelled rows of both classes every score is the share of
label 1 (0.5 if none); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rewardseg.llm.common import fresh_name, stage, table

GRAM_BITS, SHAPE_BITS, SAME = 15, 14, 16
N_FEATURES = (1 << GRAM_BITS) + (1 << SHAPE_BITS) + SAME
SAMPLE = 1500          # labelled documents per class that the linear model is fitted on
COST = 1.0             # weight of the hinge loss against the norm
EPOCHS = 12
CHUNK = 1 << 20        # bytes looked at together; chunks overlap by a margin
OVERLAP = 64
FOLDS, THRESHOLD = 5, 0.3

# character classes: letters (any byte above ASCII counts as one), capitals, digits, white space; others are themselves
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[[*range(97, 123), *range(128, 256)]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[32, 9, 10, 11, 12, 13]] = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _hashed(symbols: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hashes of all n-grams of small symbols (at most eight of them)."""
    if len(symbols) < n:
        return np.empty(0, np.int64)
    key = np.zeros(len(symbols) - n + 1, np.uint64)
    for i in range(n):
        key = (key << np.uint64(8)) | symbols[i:len(symbols) - n + 1 + i]
    key *= _MIX
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def features(text: bytes) -> np.ndarray:
    """The indices of the features present, ascending."""
    seen = np.zeros(N_FEATURES, bool)
    for at in range(0, max(len(text), 1), CHUNK):
        raw = np.frombuffer(text[max(0, at - OVERLAP):at + CHUNK], np.uint8)
        if not len(raw):
            break
        wide = raw.astype(np.uint64)
        seen[_hashed(wide, 3, GRAM_BITS)] = True
        kinds = _CLASS[raw]
        kinds = kinds[np.flatnonzero(np.diff(kinds, prepend=np.uint64(255)))]
        seen[(1 << GRAM_BITS) + _hashed(kinds, 6, SHAPE_BITS)] = True
        starts = np.flatnonzero(~_SPACE[raw] & np.concatenate([[True], _SPACE[raw[:-1]]]))
        if len(starts) > 1:
            place = np.arange(len(raw), dtype=np.uint64)
            place[starts[0]:] -= np.repeat(starts, np.diff(starts, append=len(raw))).astype(np.uint64)
            value = np.where(_SPACE[raw], np.uint64(0), (wide + np.uint64(1)) * (_MIX * (place * np.uint64(2) + np.uint64(1))))
            value ^= value >> np.uint64(29)     # else words of one weighted sum would be the same word
            word = np.add.reduceat(value, starts)
            same = (word[1:] == word[:-1]).astype(np.uint64)
            marks = np.concatenate([np.zeros(3, np.uint64), same])
            runs = marks[:-3] * 8 + marks[1:-2] * 4 + marks[2:-1] * 2 + marks[3:]
            seen[(1 << GRAM_BITS) + (1 << SHAPE_BITS) + runs.astype(np.int64)] = True
    return np.flatnonzero(seen)


# -- the model --------------------------------------------------------------

def log_count_ratios(present: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``present[c, f]``: documents of class c with feature f, of ``totals[c]``."""
    share = (present + 1.0) / (totals[:, None] + 2.0)
    return np.log(share[1] / share[0])


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: np.ndarray,
                            epochs: int = EPOCHS, seed: int = 0) -> np.ndarray:
    """Weights (the bias last) of the L2-regularised hinge loss over rows of
    scaled indicators; ``y`` is +1 or -1, ``cost`` bounds each dual variable."""
    order = np.random.default_rng(seed)
    w = np.zeros(len(scale) + 1)
    values = [np.append(scale[r], 1.0) for r in rows]
    at = [np.append(r, len(scale)) for r in rows]
    norm = np.array([v @ v for v in values])
    alpha = np.zeros(len(rows))
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            gradient = y[i] * (w[at[i]] @ values[i]) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                w[at[i]] += (new - alpha[i]) * y[i] * values[i]
                alpha[i] = new
    return w


def logistic_fit(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(label 1 | margin), by damped Newton steps;
    targets are smoothed so that separable samples keep a finite slope."""
    n1, n0 = (weight * (y > 0)).sum(), (weight * (y < 0)).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g = weight * (p - target)
        h = weight * np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(h * margin * margin).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, [(g * margin).sum(), g.sum()])
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


EVIDENCE = "label int, feature int, n long, doc_key long, present binary"


def labelled_evidence(rows: DataFrame, shares: dict[int, float]) -> DataFrame:
    """From labelled rows (doc_key, text, label): per task and class how many
    documents have each feature (feature -1: how many documents), and the
    features of the documents whose key falls in the sampled share."""
    def run(batches):
        present = np.zeros((2, N_FEATURES), np.int64)
        totals = np.zeros(2, np.int64)
        for batch in batches:
            label, key, feature = [], [], []
            for k, text, y in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = features((text or "").encode())
                present[y, found] += 1
                totals[y] += 1
                if (k % (1 << 32)) < shares[y] * (1 << 32):
                    label.append(y), key.append(k), feature.append(found.astype("<u2").tobytes())
            none = [None] * len(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.int64()),
                 pa.array(key, pa.int64()), pa.array(feature, pa.binary())],
                ["label", "feature", "n", "doc_key", "present"])
        for y in (0, 1):
            used = np.flatnonzero(present[y])
            f = np.concatenate([[-1], used])
            n = np.concatenate([[totals[y]], present[y, used]])
            none = [None] * len(f)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(f), y), pa.int32()), pa.array(f, pa.int32()), pa.array(n, pa.int64()),
                 pa.array(none, pa.int64()), pa.array(none, pa.binary())],
                ["label", "feature", "n", "doc_key", "present"])
    return rows.select("doc_key", "text", "label").mapInArrow(run, EVIDENCE)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(scale, weights, slope, intercept) from documents outside the held-out fold."""
    ids = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("label"))
    ids = (ids.where(F.col("label").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out("label_id"))
           .groupBy("label_id").agg(F.min("label").alias("label")))
    sizes = {y: n for y, n in ids.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {y: min(1.0, 1.15 * sample / max(1, sizes.get(y, 0))) for y in (0, 1)}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = (texts.where(~held_out("doc_id")).join(ids.hint("shuffle_hash"), F.col("doc_id") == F.col("label_id"))
            .select(F.xxhash64("doc_id").alias("doc_key"), "text", "label"))
    evidence = stage(labelled_evidence(rows, shares), "quality-evidence")
    counts = (evidence.where("feature is not null").groupBy("label", "feature").agg(F.sum("n").alias("n"))
              .toPandas())  # at most two rows per feature
    totals, present = np.zeros(2, np.int64), np.zeros((2, N_FEATURES), np.int64)
    is_total = counts["feature"].to_numpy() == -1
    np.add.at(totals, counts["label"][is_total], counts["n"][is_total])
    of = counts[~is_total]
    present[of["label"].to_numpy(int), of["feature"].to_numpy(int)] = of["n"].to_numpy()
    scale = log_count_ratios(present, totals)
    if totals.min() == 0:
        share = totals[1] / totals.sum() if totals.sum() else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return scale, np.zeros(N_FEATURES + 1), 1.0, float(np.log(share / (1 - share)))
    picked = []
    for y in (0, 1):
        picked += (evidence.where(F.col("present").isNotNull() & (F.col("label") == y))
                   .select("label", "doc_key", "present").orderBy("doc_key").limit(sample).collect())
    y = np.array([1.0 if r["label"] else -1.0 for r in picked])
    rows_ = [np.frombuffer(r["present"], "<u2").astype(np.int64) for r in picked]
    n = np.array([(y < 0).sum(), (y > 0).sum()])
    norm = np.mean([scale[r] @ scale[r] + 1 for r in rows_])
    w = dual_coordinate_descent(rows_, y, scale / np.sqrt(norm), np.full(len(y), COST))
    w[:-1] /= np.sqrt(norm)
    margin = np.array([scale[r] @ w[r] + w[-1] for r in rows_])
    true_share = np.where(y > 0, totals[1] / n[1], totals[0] / n[0])
    slope, intercept = logistic_fit(margin, y, true_share / true_share.mean())
    return scale, w, slope, intercept


def held_out(column: str):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def score(docs: DataFrame, model, keep: list[str], name: str = "score") -> DataFrame:
    """``docs`` columns ``keep`` with the score of each whole text."""
    scale, w, slope, intercept = model
    weights, bias = scale * w[:-1], w[-1]
    schema = docs.select(*keep).schema

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            margin = np.array([weights[features((t or "").encode())].sum() + bias
                               for t in batch.column(len(names) - 1).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(slope * margin + intercept, -35, 35)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names) - 1)), pa.array(p)],
                                             [*names[:-1], name])
    return docs.select(*keep, F.col("text").cast("string").alias(fresh_name("text", keep))).mapInArrow(
        run, StructType([*schema.fields, StructField(name, DoubleType())]))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
