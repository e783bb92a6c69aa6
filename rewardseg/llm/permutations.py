"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of its ``PREFIX`` nearest pivots, by
direction (pivots are a bounded sample of the vectors).  The index is a set
of blocks of vectors; a block holds an inverted file per pivot: the members
that have it among their nearest, in order of its place there.  A query
reads the files of its own nearest pivots and adds up what each common pivot
takes off the footrule distance (the place that a missing pivot would have
counts ``PREFIX``).

Footrule sees directions, the inner product also norms.  In each meeting of
a block with queries, a line through the exact cosines of a few members
turns footrule into an expected cosine; times the norm it ranks the members,
and the first ones, a ``RERANK`` share of every block, are ranked again by
the exact inner product.  Recall does not suffer from a few large vectors,
nor from vectors that all point one way.

Nearness is the inner product in double precision on the original vectors.
All distinct vectors are indexed, each once with its ``k`` + 1 smallest ids
(a query's own and ``k`` others); so copies take one place of the share, and
vectors that tie at its edge are all ranked again.

All blocks meet all packs of queries, as a product of two staged tables: no
row is copied or shuffled for it.  A task holds the packs (at most
``QUERY_PACK`` queries each, ``QUERY_BLOCK`` of which are met at a time) of
one scan partition, its queries' best ``k`` and an Arrow batch of pairs; the
blocks stream by.  They are cut into ``GROUPS`` runs; only a run's best ``k``
go on, and a window with a group limit keeps each query's best.  Measured
recall at 20 is in the README.

Defined cases: vectors that are null, empty, zero or hold null or
non-finite components take no part, neither do rows without an id; a shorter
vector counts as padded with zeros; a vec_id with several vectors counts
once, with the nearest of them, and a query never finds its own id; fewer candidates than ``k`` give
all of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rewardseg.llm.common import stage, table, unstage

PIVOTS, PREFIX = 192, 64
RERANK, RERANK_LEAST = 0.15, 10   # share of a block; and at least so many times k
FITTED = 256                      # members whose exact cosines place the line
BLOCK, QUERY_BLOCK, QUERY_PACK = 8192, 256, 4096
BLOCK_BYTES = 8 << 20             # of vectors in a block or a pack, so that long vectors make short ones
GROUPS = 4                        # a query brings at most so many times k rows along
K, QUERY_STEP = 20, 20
SEED = 42


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector); vectors of single precision are kept as they are."""
    v = F.col("embedding").cast("array<double>")
    kept = F.col("embedding") if vectors.select("embedding").dtypes[0][1] == "array<float>" else v
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), kept.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def _matrix(column, width: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows of one length."""
    flat, offsets = np.asarray(column.flatten()), np.asarray(column.offsets)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width))
    at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


def pivot_places(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Place of every pivot in each vector's order, at most ``prefix``."""
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
    places = np.empty(order.shape, np.int16)
    np.put_along_axis(places, order, np.broadcast_to(np.arange(order.shape[1], dtype=np.int16), order.shape), 1)
    return np.minimum(places, prefix)


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(members, vector): every distinct vector with its smallest ``ids``
    vec_ids.  A vector is known by 128 bits of hash; the ids of a vector that
    many rows share are cut in salted parts before they meet."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = rows.select("vec_id", "vector", *[F.xxhash64(F.lit(i), F.col("vector").cast("array<double>")).alias(f"h{i}") for i in (1, 2)])
    salted = keyed.select("h1", "h2", "vec_id").distinct().withColumn("salt", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(parts)))
    smallest = Window.partitionBy("h1", "h2", "salt").orderBy("vec_id")
    cut = salted.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= ids)
    lists = cut.groupBy("h1", "h2", "salt").agg(F.collect_list("vec_id").alias("part"))  # at most ids, in each of the parts
    members = lists.groupBy("h1", "h2").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("part"))), 1, ids).alias("members"))
    return keyed.groupBy("h1", "h2").agg(F.first("vector").alias("vector")).join(members.hint("merge"), ["h1", "h2"]).select(
        "members", "vector")


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix]


def posting_lists(order: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, offsets): the inverted files one after another, each in the
    order of places; entries of pivot p at place b are those from
    ``offsets[p * prefix + b]`` on."""
    n, prefix = order.shape
    key = (order.astype(np.int64) * prefix + np.arange(prefix)).ravel()
    by_key = np.argsort(key, kind="stable")
    return (by_key // prefix).astype(np.uint16), np.concatenate([[0], np.cumsum(np.bincount(key, minlength=n_pivots * prefix))])


def common_places(orders: np.ndarray, members: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """What the common pivots of each query (its pivots in order) and each of
    ``n`` members take off their footrule distance, halved: PREFIX less the
    larger of a pivot's two places, over all common pivots."""
    prefix, n_pivots = orders.shape[1], (len(offsets) - 1) // max(1, orders.shape[1])
    kind = np.int16 if prefix * prefix < 1 << 15 else np.int32
    gain = np.repeat((prefix - np.arange(len(offsets) - 1) % prefix).astype(kind), np.diff(offsets))
    files = np.zeros((n_pivots, n), kind)                   # what the pivot's place in each member leaves of PREFIX
    files[np.repeat(np.arange(n_pivots), np.diff(offsets[::prefix])), members] = gain
    files, left = list(files), [np.array(prefix - place, kind) for place in range(prefix)]
    total, add = np.zeros((len(orders), n), kind), np.empty(n, kind)
    for of, order in zip(total, orders.tolist()):
        for pivot, most in zip(order, left):                # whole files at a time: no entry is looked up by its member
            np.minimum(files[pivot], most, add)
            np.add(of, add, of)
    return total


def _packed(rows: np.ndarray) -> np.ndarray:
    """The rows in single precision if that holds them exactly."""
    with np.errstate(over="ignore"):
        short = rows.astype("<f4")
    return short if (short == rows).all() else rows.astype("<f8")


def _unpacked(buffer, n: int, width: int) -> np.ndarray:
    return np.frombuffer(buffer, "<f4" if len(buffer) == 4 * n * width else "<f8").reshape(n, width).astype(np.float64)


def blocks(rows: DataFrame, pivots: np.ndarray, size: int, prefix: int, files: bool = True) -> DataFrame:
    """(ids, sizes, vectors, places, offsets) per block of at most ``size``
    rows (members, vector): the ids of all members, how many each row has, the
    vectors and the inverted files, or with ``files`` false each row's nearest
    pivots in ``places``."""
    width = pivots.shape[1]
    size = max(1, min(size, BLOCK_BYTES // (8 * max(1, width))))

    def run(batches):
        ids, sizes, parts, held = [], [], [], 0

        def flush(n):
            nonlocal ids, sizes, parts, held
            all_ids, all_sizes, all_rows = np.concatenate(ids), np.concatenate(sizes), np.concatenate(parts)
            own, cut = all_rows[:n], int(all_sizes[:n].sum())
            ids, sizes, parts = [all_ids[cut:]], [all_sizes[n:]], [all_rows[n:]]
            held = len(sizes[0])
            order = nearest_pivots(own, pivots, prefix)
            places, offsets = posting_lists(order, len(pivots)) if files else (order.astype(np.int16), np.empty(0))
            columns = (all_ids[:cut].astype("<i8"), all_sizes[:n].astype("<i4"), _packed(own), places, offsets.astype("<i8"))
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns],
                                              ["ids", "sizes", "vectors", "places", "offsets"])

        for batch in batches:
            members = batch.column(0)
            ids.append(np.asarray(members.flatten()))
            sizes.append(np.diff(np.asarray(members.offsets)))
            parts.append(_matrix(batch.column(1), width))
            held += batch.num_rows
            while held >= size:
                yield flush(size)
        if held:
            yield flush(held)
    return rows.select("members", "vector").mapInArrow(run, "ids binary, sizes binary, vectors binary, places binary, offsets binary")


def expected_scores(common: np.ndarray, rows: np.ndarray, queries: np.ndarray, fitted: int = FITTED) -> np.ndarray:
    """Inner products over the query's norm that footrule lets expect
    (queries x members)."""
    norms = np.sqrt((rows * rows).sum(1))
    sample = np.unique(np.linspace(0, len(rows) - 1, min(len(rows), fitted)).astype(int))
    cosines = (queries / np.sqrt((queries * queries).sum(1))[:, None]) @ (rows[sample] / norms[sample, None]).T
    x, y = common[:, sample].ravel(), cosines.ravel()
    spread = ((x - x.mean()) ** 2).sum()
    slope = max(0.0, float(((x - x.mean()) * (y - y.mean())).sum() / spread)) if spread > 0 else 0.0
    return norms * (y.mean() + slope * (common - x.mean()))


def candidates(far: np.ndarray, take: int) -> np.ndarray:
    """The members of the ``take`` smallest distances, with all that tie."""
    if take >= len(far):
        return np.arange(len(far))
    return np.flatnonzero(far <= np.partition(far, take - 1)[take - 1])


def footrule(query: np.ndarray, files: np.ndarray, prefix: int) -> np.ndarray:
    """Footrule distances (queries x members) of orders cut at ``prefix``, up
    to a constant; both sides are pivot-major.  Only a query's own pivots are
    read: over the others the sum of prefix - place is what all pivots have
    together, the same for every member, less that of the query's."""
    total = np.zeros((query.shape[1], files.shape[1]), np.int32)
    for pivot in range(len(query)):
        asking = np.flatnonzero(query[pivot] < prefix)
        if len(asking):
            total[asking] += np.abs(query[pivot, asking, None] - files[pivot][None, :]) + files[pivot][None, :]
    return total


def improve(found: tuple, block: tuple, pack: tuple, k: int, rerank: float) -> None:
    """Let queries meet a block.  ``found`` holds (ids, scores, counts) of the
    best ``k`` that each query has so far, best first, and is brought up to
    date in place."""
    (best_ids, best, counts), (ids, sizes, rows, files, offsets), (q_ids, q_rows, asking) = found, block, pack
    starts = np.cumsum(sizes) - sizes
    common = common_places(asking, files, offsets, len(rows))
    far = -expected_scores(common, rows, q_rows)
    take = max(RERANK_LEAST * k, int(np.ceil(rerank * len(rows))))
    for j in range(len(q_ids)):
        near = candidates(far[j], take)
        score = (rows[near] * q_rows[j]).sum(1)
        if counts[j] == k:
            up = ~(score < best[j, -1])                     # the others cannot get in
            near, score = near[up], score[up]
        n = sizes[near]
        of = np.concatenate([best_ids[j, : counts[j]], ids[np.repeat(starts[near] - np.cumsum(n) + n, n) + np.arange(n.sum())]])
        score = np.concatenate([best[j, : counts[j]], np.repeat(score, n)])
        order = np.lexsort((of, -score))
        order = order[of[order] != q_ids[j]]
        # an id counts once, with its best score
        order = order[np.sort(np.unique(of[order], return_index=True)[1])[:k]]
        counts[j] = len(order)
        best_ids[j, : len(order)], best[j, : len(order)] = of[order], score[order]


def meetings(batches, width: int, prefix: int, k: int, rerank: float):
    """(query_id, vec_id, score) of the best ``k`` of every query, over all
    rows (block, pack of queries) of a task."""
    packs = {}
    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(9))):
            ids, sizes, rows, places, offsets, q_ids, q_rows, q_places = (c.as_buffer() for c in row[:8])
            ids, sizes, q_ids = np.frombuffer(ids, "<i8"), np.frombuffer(sizes, "<i4"), np.frombuffer(q_ids, "<i8")
            block = ids, sizes, _unpacked(rows, len(sizes), width), np.frombuffer(places, np.uint16), np.frombuffer(offsets, "<i8")
            q_rows, asking = _unpacked(q_rows, len(q_ids), width), np.frombuffer(q_places, np.int16).reshape(-1, prefix)
            if (pack := row[8].as_py()) not in packs:
                packs[pack] = q_ids.copy(), np.zeros((len(q_ids), k), np.int64), np.zeros((len(q_ids), k)), np.zeros(len(q_ids), np.int64)
            for lo in range(0, len(q_ids), QUERY_BLOCK):
                some = slice(lo, lo + QUERY_BLOCK)
                improve(tuple(x[some] for x in packs[pack][1:]), block, (q_ids[some], q_rows[some], asking[some]), k, rerank)
    for q_ids, best_ids, best, counts in packs.values():
        there = np.arange(k) < counts[:, None]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(q_ids, counts), best_ids[there], best[there])],
                                         ["query_id", "vec_id", "score"])


def query_parts(n: int, partitions: int) -> int:
    """Over how many partitions ``n`` queries are dealt: one for each block of
    queries, up to the number of shuffle partitions, and enough that a pack
    holds all of one."""
    return max(1, min(-(-n // QUERY_BLOCK), partitions), -(-n // QUERY_PACK))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, n_pivots: int = PIVOTS, prefix: int = PREFIX,
           rerank: float = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found."""
    spark = vectors.sparkSession
    index = stage(distinct_vectors(usable(vectors), k + 1), "permutation-vectors")
    # the pivots: a sample of bounded size, the same on every run
    first = F.element_at("members", 1)
    picked = index.orderBy(F.xxhash64(F.lit(SEED), first), first, F.xxhash64(F.col("vector").cast("array<double>"))).limit(n_pivots).collect()
    width = index.agg(F.max(F.size("vector"))).first()[0] or 0
    pivots = np.zeros((len(picked), width))
    for i, r in enumerate(picked):
        v = np.array(r["vector"])
        pivots[i, : len(v)] = v / np.sqrt((v * v).sum())
    prefix = min(prefix, len(pivots))
    # blocks of one scan partition each would be small: gather the rows into full blocks first
    index_blocks = stage(blocks(index.repartition(max(1, -(-index.count() // BLOCK))), pivots, BLOCK, prefix), "permutations")
    unstage(index)
    asking = stage(usable(queries).select(F.array("vec_id").alias("members"), "vector"), "permutation-queries")
    parts = query_parts(asking.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = stage(blocks(asking.repartition(parts), pivots, QUERY_PACK, prefix, files=False).select(
        F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"), F.col("places").alias("query_places"),
        F.monotonically_increasing_id().alias("pack")), "permutation-packs")
    unstage(asking)
    # a product of the two tables' partitions, each read where it is needed; a few runs of blocks, many of packs
    met = (index_blocks.coalesce(GROUPS).crossJoin(asked.hint("shuffle_replicate_nl"))
           .select("ids", "sizes", "vectors", "places", "offsets", "query_ids", "query_vectors", "query_places", "pack")
           .mapInArrow(lambda batches: meetings(batches, width, prefix, k, rerank), "query_id long, vec_id long, score double"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(nearest))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def op2_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))
