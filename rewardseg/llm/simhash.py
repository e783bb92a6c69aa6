"""SimHash near-duplicates through Golay-code fuzzy hashing.

A document's 64-bit fingerprint has a bit set where more than half of its
word shingles' XXH64 values have it.  Fingerprints link at ``MAX_BITS`` or
fewer differing bits; documents in one linked component are one group.

Candidates.  The 64 bits are cut into three segments of 21, 21 and 22 bits,
each read as a word of the perfect (23, 12) binary Golay code.  A word has
the codeword within distance 3 and, when that distance is exactly 3, five
more at distance 4; these are its keys (one or six).  Two words that differ
in at most one bit share a key: if one lies within 2 of its codeword, the
other lies within 3 of it; if both lie at 3, each one's codeword is within
4 of the other.  Three differing bits over three segments leave at least
two segments with at most one each, so the keys of a pair of segments find
every link (at most 3 x 36 keys per distinct fingerprint).

Groups need no list of all links (``links`` has it), which a group of near
copies makes the square of itself.  Fingerprints that share a key meet
sorted by (key, fingerprint), in chunks of at most ``CHUNK``, and a chunk
gives a spanning forest of its verified links: fewer links than rows.
Where a key has more than one chunk, or a task's edge cuts it, the parts
are held against each other after the components of these links are
known: only those with fingerprints of different components, and again
each two of them give a spanning forest.  So a hot key costs its square
only where it still falls apart.

Copies have one fingerprint and enter once.

Defined cases: null text and texts without a word have fingerprint zero and
are linked like any other; fewer words than a shingle make one shingle of
the whole sequence; rows repeated or sharing a doc_id are kept; a null
doc_id takes part and gets its group's component_id (null if the group has
no other); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rewardseg.llm.common import byte_sizes, fresh_name, slices, stage, table
from rewardseg.llm.graph import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT_SHARE = 2000
CHUNK = 2000              # fingerprints of a key that are held against each other at once
SMALL = 64
SLICE_BYTES = 4_000_000
SEGMENTS = ((0, 21), (21, 21), (42, 22))   # (first bit, bits)
PAIRS = ((0, 1), (0, 2), (1, 2))
GENERATOR = 0b101011100011                  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


# -- fingerprints -----------------------------------------------------------

def shingle_hashes(data: bytes, size: int, seed: int) -> list[int]:
    """XXH64 of every word shingle of a lower-cased text (bytes.split cuts at
    space, \\t, \\n, \\v, \\f and \\r only)."""
    words = data.split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())]


def fingerprints(texts: list[bytes], size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Unsigned fingerprints of a few texts."""
    hashes = [shingle_hashes(t.lower(), size, seed) for t in texts]
    counts = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    flat = np.array([x for h in hashes for x in h], np.uint64)
    starts = (np.cumsum(counts) - counts)[full]
    for bit in range(64):
        ones = np.add.reduceat(((flat >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), starts)
        out[full] |= (2 * ones > counts[full]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprint_rows(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_key, fp): a hash of the text, and its fingerprint as a
    signed 64-bit number."""
    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            for lo, hi in slices(byte_sizes(texts), SLICE_BYTES):
                part = [(t or "").encode() for t in texts.slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in (0, 1)),
                     pa.array(fingerprints(part, size, seed).view(np.int64))], ["doc_id", "text_key", "fp"])
    text = F.col("text").cast("string")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
            .mapInArrow(run, "doc_id long, text_key long, fp long"))


# -- Golay keys -------------------------------------------------------------

def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndromes: remainders modulo the generator polynomial."""
    out = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        out ^= ((out >> bit) & 1) * (GENERATOR << (bit - 11))
    return out


def coset_masks() -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome: six masks that turn a word into its nearby codewords,
    and how many of them count (1 if the nearest is within 2, else 6)."""
    ones = 1 << np.arange(23)
    leader = np.zeros(2048, np.int64)
    weight = np.zeros(2048, np.int64)
    masks = np.zeros((2048, 6), np.int64)
    def patterns_of(k):  # k ones, highest first, each pattern once
        if k == 1:
            return ones
        smaller = patterns_of(k - 1)
        return np.concatenate([smaller[smaller < o] | o for o in ones])

    for w in (1, 2, 3):
        patterns = patterns_of(w)
        at = _remainder(patterns)
        leader[at], weight[at] = patterns, w
    masks[:, 0] = leader
    filled = np.ones(2048, np.int64)
    quads = patterns_of(4)
    for pattern, s in zip(quads, _remainder(quads)):
        if weight[s] == 3:
            masks[s, filled[s]] = pattern
            filled[s] += 1
    return masks, np.where(weight == 3, filled, 1)


_MASKS: list[tuple[np.ndarray, np.ndarray]] = []


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(six codeword indices per word, how many of them count)."""
    if not _MASKS:
        _MASKS.append(coset_masks())
    masks, counts = _MASKS[0]
    s = _remainder(words)
    return (words[:, None] ^ masks[s]) >> 11, counts[s]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) of every key of every fingerprint."""
    fp = fp.view(np.uint64)
    segments = [segment_keys(((fp >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64)) for a, n in SEGMENTS]
    rows, keys = [], []
    for p, (i, j) in enumerate(PAIRS):
        (a, na), (b, nb) = segments[i], segments[j]
        for x in range(6):
            for y in range(6):
                has = np.flatnonzero((na > x) & (nb > y))
                rows.append(has)
                keys.append((p << 24) | (a[has, x] << 12) | b[has, y])
    return np.concatenate(rows), np.concatenate(keys)


# -- groups -----------------------------------------------------------------

def _keyed_rows(batches):
    for batch in batches:
        fp = batch.column(0).to_numpy()
        for lo in range(0, len(fp), 20_000):
            part = fp[lo:lo + 20_000]
            rows, keys = fuzzy_keys(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(part[rows])], ["key", "fp"])


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): every two distinct fingerprints within ``max_bits`` bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("three segments of the Golay code find up to 3 differing bits")

    keyed = prints.select("fp").mapInArrow(_keyed_rows, "key int, fp long")
    left, right = keyed.select("key", F.col("fp").alias("a")), keyed.select(F.col("key").alias("k"), F.col("fp").alias("b"))
    near = (F.col("key") == F.col("k")) & (F.col("a") < F.col("b")) & (
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # a planner's estimate knows nothing of the keys per fingerprint, so the kind of join is fixed
    return left.join(right.hint("merge"), near).select("a", "b").distinct()


def _forest(fps: np.ndarray, max_bits: int, parts: np.ndarray | None = None) -> tuple[list, list]:
    """Links that connect what all links of these fingerprints connect; with
    ``parts``, each part counts as connected."""
    near_a, near_b, rest, bits = [], [], np.arange(len(fps)), fps.view(np.uint64)   # bits of signed numbers are those of their absolute value
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        if parts is not None:
            own = parts[rest] == parts[queue[0]]
            queue, rest = queue + rest[own].tolist(), rest[~own]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(bits[rest] ^ bits[x]) <= max_bits
            if not near.any():
                continue
            hits = rest[near]
            if parts is not None:
                hits = hits[np.unique(parts[hits], return_index=True)[1]]
                near = np.isin(parts[rest], parts[hits])
            near_a += [int(fps[x])] * len(hits)
            near_b += fps[hits].tolist()
            queue += rest[near].tolist()
            rest = rest[~near]
    return near_a, near_b


def key_links(starts: np.ndarray, counts: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the fingerprints of each key (rows start, start + 1,
    ... of a key), at most twice as many as rows."""
    a, b = [], []
    for size in np.unique(counts[counts > 1]).tolist():
        first = starts[counts == size]
        if size <= SMALL:
            at = fps[first[:, None] + np.arange(size)]
            bits, found = at.view(np.uint64), []
            for shift in range(1, size):
                row, col = np.nonzero(np.bitwise_count(bits[:, shift:] ^ bits[:, :-shift]) <= max_bits)
                found.append((row, at[row, col], at[row, col + shift]))
            row, left, right = map(np.concatenate, zip(*found))
            many = np.bincount(row, minlength=len(first)) > 2 * size
            a.append(left[~many[row]])
            b.append(right[~many[row]])
            first = first[many]
        for lo in first.tolist():
            left, right = _forest(fps[lo:lo + size], max_bits)
            a.append(np.array(left, np.int64))
            b.append(np.array(right, np.int64))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def spanning_links(prints: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """(node, component) of the distinct fingerprints that have a link,
    component being the smallest fingerprint reachable."""
    if not 0 <= max_bits <= 3:
        raise ValueError("three segments of the Golay code find up to 3 differing bits")

    def chunks(batches):
        part, seq, opened = TaskContext.get().partitionId() << 32, 0, True   # opened: the key may have rows before
        keys, fps = np.empty(0, np.int32), np.empty(0, np.int64)

        def rows(a, b, key, number):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64(), from_pandas=False), pa.array(key, pa.int32()),
                                               pa.array(number, pa.int64())], ["a", "b", "key", "chunk"])

        def linked(starts, counts):
            a, b = key_links(starts, counts, fps, max_bits)
            return rows(a, b, np.full(len(a), -1, np.int32), np.zeros(len(a), np.int64))

        def waiting(lo, hi, number):   # rows of a key that may be elsewhere too: b is their own fingerprint
            return rows(fps[lo:hi], fps[lo:hi], keys[lo:hi], np.full(hi - lo, number, np.int64))
        for batch in batches:
            keys, fps = np.concatenate([keys, batch.column(0).to_numpy()]), np.concatenate([fps, batch.column(1).to_numpy()])
            if not len(keys):
                continue
            starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            counts = np.diff(starts, append=len(keys))
            whole = starts[:-1]
            if len(whole) and (opened or counts[:-1].max() > chunk):
                for i in np.flatnonzero(np.where(np.arange(len(whole)) == 0, opened, False) | (counts[:-1] > chunk)).tolist():
                    for lo in range(starts[i], starts[i] + counts[i], chunk):
                        hi = min(lo + chunk, starts[i] + counts[i])
                        yield waiting(lo, hi, part + seq)
                        yield linked(np.array([lo]), np.array([hi - lo]))
                        seq += 1
                    counts[i] = 0
                opened = False
            if len(whole):
                yield linked(whole, counts[:-1])
            keys, fps = keys[starts[-1]:], fps[starts[-1]:]
            while len(keys) > chunk:
                yield waiting(0, chunk, part + seq)
                yield linked(np.array([0]), np.array([chunk]))
                seq, opened, keys, fps = seq + 1, True, keys[chunk:], fps[chunk:]
        if len(keys):                  # the next task may have more rows of the last key
            yield waiting(0, len(keys), part + seq)
            yield linked(np.array([0]), np.array([len(keys)]))

    keyed = prints.select("fp").mapInArrow(_keyed_rows, "key int, fp long")
    met = stage(keyed.repartitionByRange("key", "fp").sortWithinPartitions("key", "fp").mapInArrow(
        chunks, "a long, b long, key int, chunk long"), "key-links")
    first = components(met.where("key < 0").select("a", "b"))
    parts = met.where("key >= 0").select("key", "chunk", F.col("a").alias("fp"))
    cut = parts.groupBy("key").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).where("lo < hi").select(F.col("key").alias("cut_key"))
    held = stage(parts.join(cut, F.col("key") == F.col("cut_key"), "left_semi").join(first, F.col("fp") == F.col("node"), "left").select(
        "key", "chunk", "fp", F.coalesce("component", "fp").alias("part")), "cut-keys")
    if held.isEmpty():
        return first
    # parts of a key, but two of one and the same component
    spans = held.groupBy("key", "chunk").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    one, other = (spans.select("key", *[F.col(c).alias(f"{c}{i}") for c in ("chunk", "lo", "hi")]) for i in (1, 2))
    cells = stage(one.join(other.hint("merge"), "key").where("chunk1 < chunk2 and (lo1 < hi1 or lo2 < hi2 or lo1 <> lo2)").select("key", "chunk1", "chunk2"), "cells")

    def crossed(batches):
        at, kept_fps, kept_parts = None, [], []

        def links_of():
            a, b = _forest(np.array(kept_fps, np.int64), max_bits, np.array(kept_parts, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if row[:3] != at:
                    if kept_fps:
                        yield links_of()
                    at, kept_fps, kept_parts = row[:3], [], []
                kept_fps.append(row[3])
                kept_parts.append(row[4])
        if kept_fps:
            yield links_of()
    of = [held.join(cells.withColumnRenamed("key", "cell_key"), (F.col("key") == F.col("cell_key")) & (F.col("chunk") == F.col(c)))
          .select("key", "chunk1", "chunk2", "fp", "part") for c in ("chunk1", "chunk2")]
    more = stage(of[0].unionByName(of[1]).repartition("key", "chunk1", "chunk2").sortWithinPartitions("key", "chunk1", "chunk2")
                 .mapInArrow(crossed, "a long, b long"), "cross-links")
    if more.isEmpty():
        return first
    return components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))


def grouped(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_key, fp, group, component_id) per row: ``group`` names
    the linked component, ``component_id`` is its smallest doc_id."""
    rows = stage(fingerprint_rows(docs, size), "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "prints")
    linked = prints.join(spanning_links(prints, max_bits), F.col("fp") == F.col("node")).select("fp", "least", "component")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    of_linked = linked.join(least, "component").select("fp", "component", "component_id")
    of_print = prints.join(of_linked, "fp", "left").select(
        "fp", "n", F.coalesce("component", "fp").alias("group"), F.coalesce("component_id", "least").alias("component_id"))
    of_print = stage(of_print, "print-groups")
    # a fingerprint of more than one in HOT_SHARE rows is one of at most HOT_SHARE: those go to every task, the
    # others are joined by shuffle, where none is hot
    total = of_print.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(of_print.where(F.col("n") * HOT_SHARE > total).select(
        "fp", F.col("group").alias("hot_group"), F.col("component_id").alias("hot_id"), F.lit(True).alias("is_hot")))
    marked = rows.join(hot, "fp", "left")
    columns = ("doc_id", "text_key", "fp")
    common = marked.where("is_hot is null").select(*columns).join(of_print.drop("n"), "fp")
    return marked.where("is_hot").select(*columns, F.col("hot_group").alias("group"), F.col("hot_id").alias("component_id")
                                         ).unionByName(common.select(*columns, "group", "component_id"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row."""
    return grouped(docs, size, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs``, all columns, of each group: the smallest doc_id
    (null last; of rows that share it the smallest text hash)."""
    of_group = grouped(docs, size, max_bits).groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"))
    no_id, of_id, of_text, turn = (fresh_name(n, docs.columns) for n in ("keep_no_id", "keep_doc_id", "keep_text_key", "keep_turn"))
    keep = of_group.select(*[F.col(f"first.{c}").alias(n) for c, n in (("no_id", no_id), ("doc_id", of_id), ("text_key", of_text))])
    doc_id = docs["doc_id"].cast("long")
    key = F.xxhash64(docs["text"].cast("string"))
    kept = docs.join(keep, (F.coalesce(doc_id, F.lit(0)) == F.coalesce(of_id, F.lit(0))) &
                     (doc_id.isNull() == F.col(no_id)) & (key == F.col(of_text)))
    same = Window.partitionBy(of_id, no_id, of_text).orderBy(of_text)
    return kept.withColumn(turn, F.row_number().over(same)).where(F.col(turn) == 1).select(*[docs[c] for c in docs.columns])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
