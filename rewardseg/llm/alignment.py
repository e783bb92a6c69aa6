"""Alignment of two tokenizers' tokens over the bytes of a text.

Each tokenizer gives a sparse token-byte incidence matrix (a row per token,
a one per byte it covers), kept in CSR form (``indptr``, ``indices``).  Row
products after Gustavson, A times B transposed, have an entry for every
two tokens with a byte in common: the overlap links, with the shared bytes.
Positions where tokens of both end cut the text into groups; the product of
the two token-group incidence matrices has the links of tokens that share
a group.  The products run over many words at once, as block-diagonal
matrices, and each distinct word of a task is aligned once.

Words.  A space behind a character that is not white space opens a token
in both tokenizers: a byte-level BPE never merges across it, and no piece
of the other vocabulary holds a space inside.  Both are checked when the
tokenizers are loaded; texts are aligned whole where one of them fails.

Corpus counts.  How many links hold an id pair is a sum over all documents,
combined in each task before the shuffle.  The pairs with more than one in
``HOT_PAIRS`` of all links are at most ``HOT_PAIRS``, whatever the corpus:
they are broadcast and meet their links in the tasks that hold them.  All
other pairs are rows (document, pair, links) that meet the counts in a
shuffle join, where none of them is hot.

Defined cases: a null or empty text, or one whose tokens of either kind do
not spell a space and the text, has no tokens: zeros, an empty groups
digest and no link in the counts; every row is one row of the result,
repeated rows and null doc_ids too; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from rewardseg.llm.common import byte_sizes, kept, slices, stage, table
from rewardseg.llm.tokens import byte_table, cuts_at_spaces, default_tokenizer

HOT_PAIRS = 1 << 20
MEMO_WORDS = 120_000
MEMO_LINKS = 2_000_000
SLICE_BYTES = 1_500_000
COUNT_PAIRS = 1_000_000   # pairs that a task gathers before it sums them
LEARN_WORDS = 8000
JOINED_WORDS = 100
SPACE = "▁"          # how sentencepiece writes a space
_CUT = re.compile(r"(?<=\S)(?= )")
_UNEVEN = r"(?:\A|[\s\x0b\x1c-\x1f\x{85}\p{Z}]) "     # for Arrow: a space at the start or behind white space
_ENDS_OPEN = re.compile(r"\s(?: |\Z)|\u2581")


def default_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


# -- sparse products ------------------------------------------------------------

def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``count`` numbers, one run after another."""
    take = np.repeat(starts - np.cumsum(counts) + counts, counts)
    take += np.arange(len(take))
    return take


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of every run of ``counts`` values."""
    out, filled = np.zeros(len(counts), np.int64), np.flatnonzero(counts)
    if len(filled):
        out[filled] = np.add.reduceat(values, (np.cumsum(counts) - counts)[filled], dtype=np.int64)
    return out


def incidence(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CSR of tokens by bytes, for tokens that lie end to end."""
    indptr = np.concatenate([[0], np.cumsum(lengths)])
    return indptr, np.arange(indptr[-1])


def transposed(indptr: np.ndarray, indices: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """CSR of the transposed matrix of ones."""
    rows = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
    order = np.argsort(indices, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(indices, minlength=columns))]), rows[order]


def row_products(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson's product of two matrices of ones: each entry of a row of
    ``a`` brings in a row of ``b``, and equal columns are added up.  Returns
    (indptr, indices, values)."""
    (ap, ai), (bp, bi) = a, b
    counts = np.diff(bp)[ai]
    rows = np.repeat(np.repeat(np.arange(len(ap) - 1), np.diff(ap)), counts)
    key = rows * columns + bi[_runs(bp[ai], counts)]
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    values = np.diff(first, append=len(key))
    rows, cols = key[first] // columns, key[first] % columns
    return np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(ap) - 1))]), cols, values


def overlap_links(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, shared bytes) of all overlapping tokens of two
    tokenizations of the same bytes."""
    a, b = incidence(a_lengths), incidence(b_lengths)
    indptr, cols, shared = row_products(a, transposed(*b, columns=int(b[0][-1])), max(len(b_lengths), 1))
    return np.repeat(np.arange(len(a_lengths)), np.diff(indptr)), cols, shared


def group_numbers(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A token and of every B token."""
    a, b = np.cumsum(a_lengths), np.cumsum(b_lengths)
    common = np.intersect1d(a, b, assume_unique=True)
    return np.searchsorted(common, a), np.searchsorted(common, b)


def group_links(a_groups: np.ndarray, b_groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of all tokens in one group: the product of the
    token-group incidence matrices."""
    n = int(max(a_groups.max(initial=-1), b_groups.max(initial=-1))) + 1
    a = np.arange(len(a_groups) + 1), a_groups
    b = transposed(np.arange(len(b_groups) + 1), b_groups, n)
    indptr, cols, _ = row_products(a, b, max(len(b_groups), 1))
    return np.repeat(np.arange(len(a_groups)), np.diff(indptr)), cols


# -- words ------------------------------------------------------------------------

class Aligner:
    """Aligns words, each taken with the space before it, and remembers them."""

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = byte_table(self.a)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.a_bytes, self.b_bytes))
        self.a_opens, self.b_opens = (np.array([x[:1] == b" " for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id(SPACE)
        # ids as the digest spells them, with the sign before them: ; and | open a group's sides, commas go between
        self.spelled = [b"%s%d" % (sign, i) for table, first in ((self.a_bytes, b";"), (self.b_bytes, b"|")) for sign in (first, b",") for i in range(len(table))]
        self.spelled_sizes = np.fromiter(map(len, self.spelled), np.int64, len(self.spelled))
        self.pair_type = np.uint32 if len(self.a_bytes) * len(self.b_bytes) < 2 ** 32 else np.int64
        self.by_word = cuts_at_spaces(self.a) and not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.texts: list[bytes] = []                     # a word's groups, as the digest spells them, a ; before each
        self.numbers = np.empty((0, 5), np.int64)        # A tokens, B tokens, groups, links, group links; -1: does not spell the word
        self.pairs = np.empty(0, self.pair_type)
        self.starts = np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)
        self.new: list[tuple[np.ndarray, ...]] = []      # starts, pairs and numbers learned since
        self.new_links = 0

    def _thin(self) -> None:
        """Make room: half of it for the words used most, if more than once."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > MEMO_WORDS // 2:
            keep = np.sort(keep[np.argpartition(-self.uses[keep], MEMO_WORDS // 2)[:MEMO_WORDS // 2]])
        if int(np.maximum(self.numbers[keep, 3], 0).sum()) > MEMO_LINKS // 2 or not self.by_word:
            return self.forget()
        place = np.full(len(self.uses), -1, np.int64)
        place[keep] = np.arange(len(keep))
        at = place.tolist()
        self.rows = {w: at[r] for w, r in self.rows.items() if at[r] >= 0}
        self.texts = [self.texts[i] for i in keep.tolist()]
        links = np.maximum(self.numbers[keep, 3], 0)
        self.pairs = self.pairs[_runs(self.starts[keep], links)]
        self.starts, self.numbers, self.uses = np.cumsum(links) - links, self.numbers[keep], np.ones(len(keep), np.int64)

    def _words(self, text: str) -> list[str]:
        """A text's words, each without the space before it."""
        return [w[1:] for w in _CUT.split(" " + text)] if self.by_word else [text]

    def _coded(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct words of a column, the number of each word of all its
        texts end to end, and the words per text.  Texts where each space
        begins a word are split by Arrow."""
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        filled = byte_sizes(texts) > 0
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False) if self.by_word else filled
        even = filled & ~uneven
        pieces = pc.split_pattern(texts.filter(pa.array(even)), " ")
        flat, counts = pieces.flatten(), np.zeros(len(texts), np.int64)
        counts[even] = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        starts = np.cumsum(counts) - counts
        if uneven.any():
            others = [self._words(t) for t in texts.filter(pa.array(uneven)).to_pylist()]
            counts[uneven] = n = np.fromiter(map(len, others), np.int64, len(others))
            starts[uneven] = len(flat) + np.cumsum(n) - n
            flat = pa.concat_arrays([flat, pa.array(itertools.chain.from_iterable(others), pa.large_string())])
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return coded.dictionary.to_pylist(), codes[_runs(starts, counts)] if uneven.any() else codes, counts

    def _joins(self, words: list[str], joined: str) -> bool:
        """Whether words joined by spaces have the tokens that each has: none
        is empty, holds a space or ends in white space."""
        return self.by_word and "" not in words and joined.count(" ") == len(words) - 1 and not _ENDS_OPEN.search(joined)

    def _tokens(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per tokenizer: the ids of all words, each after a space, end to
        end, and how many each word has.  Words are encoded many at a time,
        where a token that begins with a space begins a word."""
        parts = [words[i:i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        joined = [" ".join(part) for part in parts]
        plain = [self._joins(part, text) for part, text in zip(parts, joined)]
        sides = []
        for encode, opens in ((self._encode_a, self.a_opens), (self._encode_b, self.b_opens)):
            found = [encode([text])[0] if together else [] for text, together in zip(joined, plain)]
            ids, ends = np.fromiter(itertools.chain.from_iterable(found), np.int64), np.cumsum([0, *map(len, found)])
            begins = np.flatnonzero(opens[ids])
            if all(plain) and (np.diff(np.searchsorted(begins, ends)) == [len(part) for part in parts]).all():
                sides.append((ids, np.diff(begins, append=len(ids))))
                continue
            each = list(itertools.chain.from_iterable(
                np.split(flat, begins[1:]) if together and len(begins) == len(part) else map(np.array, encode(part))
                for part, together, flat, begins in ((part, together, np.array(flat, np.int64), np.flatnonzero(opens[flat]) if flat else flat)
                                                     for part, together, flat in zip(parts, plain, found))))
            sides.append((np.concatenate([np.empty(0, np.int64), *each]).astype(np.int64), np.fromiter(map(len, each), np.int64, len(each))))
        return sides

    def _encode_a(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]

    def _encode_b(self, words: list[str]) -> list[list[int]]:
        return [self.b.encode(w) if w else [self.space] for w in words]

    def _spelled(self, words: list[str], sides) -> np.ndarray:
        """Which words the tokens of both kinds spell."""
        whole, sizes = b"".join([b" ", " ".join(words).encode()]) if words else b"", byte_sizes(pa.array(words, pa.large_string())) + 1
        fits = np.ones(len(words), bool)
        for (ids, counts), spell, bytes_of in zip(sides, (self.a_bytes, self.b_bytes), (self.a_sizes, self.b_sizes)):
            ends = np.cumsum(counts)
            total = np.concatenate([[0], np.cumsum(bytes_of[ids])])
            if (total[ends] - total[ends - counts] == sizes).all() and b"".join(map(spell.__getitem__, ids.tolist())) == whole:
                continue
            fits &= [b"".join(map(spell.__getitem__, ids[e - n:e].tolist())) == b" " + w.encode() for w, e, n in zip(words, ends.tolist(), counts.tolist())]
        return fits

    def _learn(self, words: list[str]) -> None:
        sides = self._tokens(words)
        fits = self._spelled(words, sides)
        (a_ids, a_count), (b_ids, b_count) = ((ids, n) if fits.all() else (ids[np.repeat(fits, n)], np.where(fits, n, 0)) for ids, n in sides)
        a_word, b_word = (np.repeat(np.arange(len(words)), n) for n in (a_count, b_count))
        of_a, of_b, _ = overlap_links(self.a_sizes[a_ids], self.b_sizes[b_ids])
        a_group, b_group = group_numbers(self.a_sizes[a_ids], self.b_sizes[b_ids])
        n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
        per_group = np.bincount(a_group, minlength=n_groups) * np.bincount(b_group, minlength=n_groups)
        group_word = np.zeros(n_groups, np.int64)
        group_word[a_group] = a_word
        count = lambda word, weights=None: np.bincount(word, weights, len(words)).astype(np.int64)
        numbers = np.stack([a_count, b_count, count(group_word), count(a_word[of_a]), count(group_word, per_group)], axis=1)
        numbers[~fits] = -1
        # spelled groups: a group's A ids, then its B ids
        first_a, first_b = (np.diff(group, prepend=-1) != 0 for group in (a_group, b_group))
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[np.arange(len(a_ids)) + np.searchsorted(b_group, np.arange(n_groups))[a_group]] = a_ids + len(self.a_bytes) * ~first_a
        order[np.arange(len(b_ids)) + np.searchsorted(a_group, np.arange(n_groups), "right")[b_group]] = (
            2 * len(self.a_bytes) + b_ids + len(self.b_bytes) * ~first_b)
        spelled = b"".join(map(self.spelled.__getitem__, order.tolist()))
        ends = np.concatenate([[0], np.cumsum(self.spelled_sizes[order])])[np.cumsum(a_count + b_count)].tolist()
        base = len(self.texts)
        self.texts += [spelled[x:y] for x, y in zip([0, *ends], ends)]
        self.rows.update(zip(words, range(base, base + len(words))))
        links = np.maximum(numbers[:, 3], 0)
        pairs = a_ids[of_a] * len(self.b_bytes) + b_ids[of_b]
        self.new.append((len(self.pairs) + self.new_links + np.cumsum(links) - links, pairs.astype(self.pair_type), numbers))
        self.new_links += int(links.sum())

    def align_column(self, column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Per text, as arrays: the five numbers, the groups' digests, the id
        pairs of all links end to end, and how many each text has."""
        if len(self.texts) > MEMO_WORDS or len(self.pairs) > MEMO_LINKS or not self.by_word:
            self._thin()
        words, codes, counts = self._coded(column)
        missing = [w for w in words if w not in self.rows]
        if not self._joins(missing, " ".join(missing)):      # some are encoded one by one, so kept apart from the others
            missing.sort(key=lambda w: not w or " " in w or SPACE in w or w[-1].isspace())
        for i in range(0, len(missing), LEARN_WORDS):
            self._learn(missing[i:i + LEARN_WORDS])
        if self.new:
            starts, pairs, numbers = zip(*self.new)
            self.starts, self.pairs, self.numbers = (np.concatenate([x, *y]) for x, y in zip(
                (self.starts, self.pairs, self.numbers), (starts, pairs, numbers)))
            self.new, self.new_links = [], 0
        distinct = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        self.uses = np.concatenate([self.uses, np.zeros(len(self.texts) - len(self.uses), np.int64)])
        self.uses[distinct] += np.bincount(codes, minlength=len(words))
        known = self.numbers[distinct]
        good = (counts > 0) & (_sums(known[codes, 0] < 0, counts) == 0)
        numbers = np.stack([_sums(column[codes], counts) for column in np.ascontiguousarray(known.T)], axis=1)
        numbers[~good] = 0
        links = np.where(np.repeat(good, counts), known[codes, 3], 0)
        digests, spelled, ends = [""] * len(counts), list(map(self.texts.__getitem__, distinct.tolist())), np.cumsum(counts)
        for i in np.flatnonzero(good).tolist():
            text = b"".join(map(spelled.__getitem__, codes[ends[i] - counts[i]:ends[i]].tolist()))
            digests[i] = hashlib.sha256(memoryview(text)[1:]).hexdigest()
        return numbers, digests, self.pairs[_runs(self.starts[distinct][codes], links)], numbers[:, 3]

    def align(self, texts: list[str | None]):
        """Per text: (A tokens, B tokens, groups, links, group links), the
        groups' digest, and the id pairs of its links."""
        numbers, digests, pairs, links = self.align_column(pa.array(texts, pa.large_string()))
        yield from zip(numbers, digests, np.split(pairs, np.cumsum(links)[:-1]))

    def positions(self, text: str) -> tuple[np.ndarray, ...] | None:
        """(A ids, their bytes, B ids, their bytes) of a whole text; None if
        they do not spell it."""
        words = self._words(text)
        sides = self._tokens(words)
        if not self._spelled(words, sides).all():
            return None
        (a, _), (b, _) = sides
        return a, self.a_sizes[a], b, self.b_sizes[b]


def aligner(a_path: str, b_path: str) -> Aligner:
    return kept(("aligner", a_path, b_path), lambda: Aligner(a_path, b_path))


# -- documents ----------------------------------------------------------------------

def token_links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, shared: str = "bytes") -> DataFrame:
    """The links themselves: (doc_id, a_pos, b_pos, a_id, b_id, shared) with
    the number of shared bytes, or with ``shared="group"`` all links of tokens
    in one group and the group's number."""
    a_path, b_path = a_path or default_tokenizer(), b_path or default_pieces()

    def run(batches):
        tool = aligner(a_path, b_path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = tool.positions(text) if text else None
                if found is None:
                    continue
                a, a_sizes, b, b_sizes = found
                if shared == "group":
                    groups = group_numbers(a_sizes, b_sizes)
                    x, y = group_links(*groups)
                    value = groups[0][x]
                else:
                    x, y, value = overlap_links(a_sizes, b_sizes)
                for lo in range(0, len(x), 100_000):
                    p, q = x[lo:lo + 100_000], y[lo:lo + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(p), pa.int64()), *map(pa.array, (p, q, a[p], b[q], value[lo:lo + 100_000]))],
                                                     ["doc_id", "a_pos", "b_pos", "a_id", "b_id", "shared"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, a_pos long, b_pos long, a_id long, b_id long, shared long")


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: a row number, doc_id, the counts, the groups' digest and the
    id pairs of its links (32-bit numbers, or 64-bit for large vocabularies)."""
    def run(batches):
        tool, base, n = aligner(a_path, b_path), TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in slices(byte_sizes(texts), SLICE_BYTES):
                numbers, digests, pairs, links = tool.align_column(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + n + np.arange(hi - lo)), batch.column(0).slice(lo, hi - lo), *(pa.array(numbers[:, i]) for i in range(5)),
                     pa.array(digests, pa.string()), _binary(pairs, links)],
                    ["row", "doc_id", *NUMBERS, "groups_sha256", "pairs"])
                n += hi - lo
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(
        run, "row long, doc_id long, " + ", ".join(f"{c} long" for c in NUMBERS) + ", groups_sha256 string, pairs binary")


def _binary(pairs: np.ndarray, links: np.ndarray) -> pa.Array:
    """A binary value per text, of the pairs of its links."""
    ends = pa.array(np.concatenate([[0], np.cumsum(links * pairs.itemsize)]), pa.int64())
    return pa.Array.from_buffers(pa.large_binary(), len(links), [None, ends.buffers()[1], pa.py_buffer(pairs)]).cast(pa.binary())


def _pairs(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a binary column end to end, and how many each row has."""
    if not len(column):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if ends[-1] > ends[0] else np.empty(0, np.uint8)
    return data[ends[0]:ends[-1]].view(np.uint32 if width == 4 else np.int64), np.diff(ends) // width


def pair_counts(rows: DataFrame, width: int, b_ids: int) -> DataFrame:
    """(pair, total, best): how many links hold the id pair in all documents,
    and if none of its B id's pairs has more."""
    def run(batches):
        pairs, counts, held = [], [], 0

        def summed():
            both, at = np.unique(np.concatenate(pairs), return_inverse=True)
            return both, np.bincount(at, np.concatenate(counts), len(both)).astype(np.int64)
        for batch in batches:
            every, _ = _pairs(batch.column(0), width)
            for lo in range(0, len(every), COUNT_PAIRS):
                part, n = np.unique(every[lo:lo + COUNT_PAIRS], return_counts=True)
                pairs.append(part)
                counts.append(n)
                held += len(part)
                if held >= COUNT_PAIRS:
                    both, n = summed()
                    pairs, counts, held = [both], [n], len(both)
                    if held > COUNT_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(both, pa.int64()), pa.array(n)], ["pair", "n"])
                        pairs, counts, held = [], [], 0
        if held:
            both, n = summed()
            yield pa.RecordBatch.from_arrays([pa.array(both, pa.int64()), pa.array(n)], ["pair", "n"])
    totals = stage(rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    b = F.col("pair") % b_ids
    most = totals.groupBy(b.alias("b")).agg(F.max("total").alias("most"))     # at most a row per id of the vocabulary
    return stage(totals.join(F.broadcast(most), b == F.col("b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best")), "pair-totals")


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, n_group_links."""
    spark = docs.sparkSession
    a_path, b_path = a_path or default_tokenizer(), b_path or default_pieces()
    b_ids = sentencepiece.SentencePieceProcessor(model_file=b_path).vocab_size()
    width = 4 if len(byte_table(Tokenizer.from_file(a_path))) * b_ids < 2 ** 32 else 8
    rows = stage(aligned(docs, a_path, b_path), "aligned")
    totals = pair_counts(rows, width, b_ids)
    links = totals.agg(F.sum("total")).first()[0] or 0
    hot = totals.where(F.col("total") * hot_pairs > links).toArrow()
    order = np.argsort(hot.column("pair").to_numpy())
    shipped = spark.sparkContext.broadcast((hot.column("pair").to_numpy()[order], hot.column("total").to_numpy()[order],
                                            hot.column("best").to_numpy()[order]))

    def counted(batches):
        """The sums over the links of hot pairs, and the other pairs with
        their links; a pair is looked up once for many documents."""
        pair, total, best = shipped.value
        for batch in batches:
            every, links = _pairs(batch.column(batch.num_columns - 1), width)
            ends = np.cumsum(links)
            for lo, hi in slices(links, COUNT_PAIRS):
                part, counts = every[ends[lo] - links[lo]:ends[hi - 1]], links[lo:hi]
                coded = pa.array(part).dictionary_encode()
                distinct, codes = coded.dictionary.to_numpy().astype(np.int64), coded.indices.to_numpy()
                at = np.minimum(np.searchsorted(pair, distinct), max(len(pair) - 1, 0))
                known = pair[at] == distinct if len(pair) else np.zeros(len(distinct), bool)
                of_hot = [np.where(known, x[at], 0) if len(pair) else np.zeros(len(distinct), np.int64) for x in (best, total)]
                rare = np.flatnonzero(~known[codes])
                keys, n = np.unique(np.repeat(np.arange(hi - lo), counts)[rare] * len(distinct) + codes[rare], return_counts=True)
                cuts = pa.array(np.searchsorted(keys, np.arange(hi - lo + 1) * len(distinct)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)), *(pa.array(_sums(x[codes], counts)) for x in of_hot),
                     *(pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (distinct[keys % max(len(distinct), 1)], n))], names)

    names = ["row", "doc_id", *NUMBERS, "groups_sha256", "hot_best", "hot_sum", "pair", "n"]
    near = stage(rows.mapInArrow(counted, "row long, doc_id long, " + ", ".join(f"{c} long" for c in NUMBERS)
                                 + ", groups_sha256 string, hot_best long, hot_sum long, pair array<long>, n array<long>"), "hot-sums")
    rare = near.select("row", F.explode(F.arrays_zip("pair", "n")).alias("of")).select("row", "of.pair", "of.n").join(totals, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("rare_best"), F.sum(F.col("n") * F.col("total")).alias("rare_sum"))
    return near.drop("pair", "n").join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("hot_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"), "groups_sha256", "n_group_links")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
