"""Best-fit packing of documents into sequences of a fixed capacity.

Documents longer than the capacity are cut into full pieces behind one
shorter first piece.  The lengths form a histogram (at most ``capacity``
numbers, so it fits the driver at any corpus size) and the packing is a
configuration linear program over it: minimise the number of sequences,
each filled by a configuration (a multiset of lengths within the capacity),
so that every length is covered.  It is solved by multiplicative weights:
a length's weight falls as it gets covered, and each step prices the best
configuration by a knapsack dynamic program.  Rounding takes the whole part
of each configuration's share, solves the rest again, and places the last
few thousand pieces by best fit.

The plan (configuration, how many) is turned into places with arithmetic:
pieces of one length are numbered across all partitions, and the number
says which copy of which configuration a piece belongs to and its offset.

Defined cases: null text is the empty text (one piece, the end id alone);
rows with the same or a null doc_id are packed one by one; an empty table
gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rewardseg.llm.common import byte_sizes, slices, stage, table
from rewardseg.llm.tokens import SLICE_BYTES, default_tokenizer, encoder, with_end

CAPACITY = 2048
END_ID = 0
STEPS = 160          # weight updates per linear program
RATE = 8.0           # how fast a length's weight falls as its demand gets covered
POWER = 1.6          # a length's value before any update: long pieces first, short ones to fill
MEMO_WORDS = 450_000  # words that a worker remembers; less memory for more encoding
LAST_PIECES = 1000   # pieces left for best fit after the last rounding


# -- pieces -----------------------------------------------------------------

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, shard int, nth long"


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``nth`` numbers the pieces of one length within
    the task ``shard``."""
    def run(batches):
        from pyspark import TaskContext
        enc, shard = encoder(tokenizer, MEMO_WORDS), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids_of_doc = batch.column(0).to_pylist()
            texts = batch.column(1)
            for lo, hi in slices(byte_sizes(texts), SLICE_BYTES):
                ids, per_text = with_end(*enc.encode(texts.slice(lo, hi - lo)), end_id)
                raw = ids.astype("<u4")
                n_pieces = -(-per_text // capacity)
                doc = np.repeat(np.arange(len(per_text)), n_pieces)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                first = per_text - (n_pieces - 1) * capacity
                length = np.where(number == 0, first[doc], capacity)
                start = np.where(number == 0, 0, first[doc] + (number - 1) * capacity)
                at = (np.cumsum(per_text) - per_text)[doc] + start
                order = np.argsort(length, kind="stable")
                run_start = np.searchsorted(length[order], length[order])
                nth = np.empty(len(doc), np.int64)
                nth[order] = np.arange(len(doc)) - run_start
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids_of_doc[lo + d] for d in doc], pa.int64()), pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                    pa.array([zlib.crc32(raw[a:a + n]) for a, n in zip(at, length)], pa.int64()),
                    pa.array(np.full(len(doc), shard), pa.int32()), pa.array(nth, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "shard", "nth"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, PIECES))


# -- the plan (driver, on the histogram) ------------------------------------

def best_configuration(value: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack by dynamic programming: the multiset of lengths within the
    capacity of the largest total value, as counts per length."""
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        options = value[1:c + 1] + best[c - 1::-1]
        k = int(np.argmax(options))
        if options[k] > best[c - 1]:
            best[c], pick[c] = options[k], k + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(capacity + 1, np.int64), capacity
    while c > 0:
        if pick[c]:
            counts[pick[c]] += 1
            c -= pick[c]
        else:
            c -= 1
    return counts


def solve(demand: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[np.ndarray, float]]:
    """Multiplicative weights for the covering program; the shares returned
    cover no length more than its demand."""
    covered, shares = np.zeros(capacity + 1), []
    present = demand > 0
    lengths = np.arange(capacity + 1, dtype=float)
    need = np.where(present, demand, 1).astype(float)
    for _ in range(steps):
        open_ = present & (demand - covered >= 1)
        if not open_.any():
            break
        done = covered / need
        weight = np.exp(-RATE * (done - done[open_].min()))
        value = np.where(open_, lengths ** POWER * weight, -1.0)
        counts = best_configuration(value, capacity)
        used = counts > 0
        room = float(((demand - covered)[used] / counts[used]).min())
        total = float((demand * lengths).sum()) / capacity
        share = min(room, max(total / steps * 2, 1.0))
        if room < 1:
            covered[used & (demand - covered < counts)] = demand[used & (demand - covered < counts)]
            continue
        covered += share * counts
        shares.append((counts, share))
    return shares


def lower_bound(histogram: np.ndarray, capacity: int = CAPACITY, steps: int = STEPS) -> float:
    """A number of sequences that no packing can go below: the best dual
    solution of the weights' way, from both the length's share of the capacity
    (the volume) and weights that rise for lengths the configurations of
    the steps before left uncovered."""
    demand = histogram.astype(float)
    if not demand.any():
        return 0.0
    lengths = np.arange(capacity + 1) / capacity
    bound, weight, covered = float((demand * lengths).sum()), np.ones(capacity + 1), np.zeros(capacity + 1)
    for step in range(1, steps + 1):
        value = np.where(demand > 0, lengths * weight, 0.0)
        counts = best_configuration(value, capacity)
        bound = max(bound, float((demand * value).sum() / (value * counts).sum()))
        # covered as if each step's configuration had an equal share of the bound
        covered += counts * bound / np.maximum(demand, 1)
        weight = np.exp(RATE / 4 * (1 - np.minimum(covered / step, 1)))
    return bound


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """[(configuration as ((length, copies), ...), number of sequences)]
    covering the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def take(counts, n):
        used = np.flatnonzero(counts)
        left[used] -= counts[used] * n
        out.append((tuple((int(x), int(counts[x])) for x in used), int(n)))

    if left[capacity]:
        full = np.zeros(capacity + 1, np.int64)
        full[capacity] = 1
        take(full, left[capacity])
    while left.sum() > LAST_PIECES:
        before = int(left.sum())
        for counts, share in solve(left, capacity):
            used = counts > 0
            n = min(int(share), int((left[used] // counts[used]).min()))
            if n > 0:
                take(counts, n)
        if int(left.sum()) > before * 0.9:
            break
    if left.sum() > 10 * LAST_PIECES:  # lengths of which the program leaves many: whole multiples of the best filling
        while left.sum() > LAST_PIECES:
            longest = int(np.flatnonzero(left)[-1])
            counts = np.zeros(capacity + 1, np.int64)
            room = capacity
            for x in np.flatnonzero(left)[::-1]:
                fit = min(room // int(x), int(left[x]))
                counts[x], room = fit, room - fit * int(x)
            counts[longest] = max(1, counts[longest])
            used = counts > 0
            take(counts, max(1, int((left[used] // counts[used]).min())))
    out.extend((config, 1) for config in best_fit(left, capacity))
    return out


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, int], ...]]:
    """Best fit decreasing of the pieces left, through bins by free space."""
    bins: list[dict[int, int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = np.zeros(capacity + 1, bool)
    for x in np.flatnonzero(left)[::-1]:
        for _ in range(int(left[x])):
            fits = np.flatnonzero(some[x:])
            if len(fits):
                room = int(x + fits[0])
                b = free[room].pop()
                some[room] = bool(free[room])
            else:
                b, room = len(bins), capacity
                bins.append({})
            bins[b][int(x)] = bins[b].get(int(x), 0) + 1
            rest = room - int(x)
            free[rest].append(b)
            some[rest] = rest > 0
    return [tuple(sorted(b.items())) for b in bins]


def places(planned, capacity: int) -> pd.DataFrame:
    """Per (length, configuration): the first piece number it takes, copies
    per sequence, its first sequence and the offset of its first copy.
    Ordered by (length, first)."""
    taken = np.zeros(capacity + 1, np.int64)
    sequence, rows = 0, []
    for config, n in planned:
        offset = 0
        for length, copies in config:
            rows.append((length, int(taken[length]), copies, sequence, offset))
            taken[length] += copies * n
            offset += length * copies
        sequence += n
    return pd.DataFrame(rows, columns=["length", "first", "copies", "sequence", "offset"]).sort_values(
        ["length", "first"], kind="stable")


# -- the operator -----------------------------------------------------------

def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces with (sequence_id, offset); a sequence's pieces lie end to end
    from offset 0 and hold at most ``capacity`` ids."""
    pieces = stage(document_pieces(docs, tokenizer or default_tokenizer(), capacity, end_id), "pieces")
    per_shard = stage(pieces.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in per_shard.groupBy("length").agg(F.sum("n")).collect():  # at most one row per length
        histogram[length] = n
    where = places(plan(histogram, capacity), capacity)
    key = (where["length"].to_numpy(np.int64) << 40) + where["first"].to_numpy(np.int64)
    columns = [where[c].to_numpy(np.int64) for c in ("first", "copies", "sequence", "offset")]
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_shard.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # a row per length and task: their number follows the input, so they are not broadcast
    numbered = (pieces.join(bases.hint("merge"), ["length", "shard"])
                .select("doc_id", "piece", "start", "length", "ids_crc32",
                        (F.col("base") + F.col("nth")).alias("number")))

    def run(batches):
        first, copies, sequence, offset = columns
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy().astype(np.int64)
            number = batch.column(names.index("number")).to_numpy()
            at = np.searchsorted(key, (length << 40) + number, "right") - 1
            turn, slot = np.divmod(number - first[at], copies[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(length), batch.column(4),
                 pa.array(sequence[at] + turn), pa.array(offset[at] + slot * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return numbered.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
