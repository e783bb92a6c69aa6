"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

# Bytes of a dimension side we are willing to ship to every executor.
DIM_BROADCAST_BYTES = 128 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as a broadcast holds it: 8 per column and null word,
    and the bytes of its strings."""
    fixed = F.lit(8 * (len(df.columns) + 1)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            fixed = fixed + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
    return fixed


def bounded_sizes(dims: dict[str, DataFrame], max_bytes: int = DIM_BROADCAST_BYTES) -> dict[str, bool]:
    """Which of ``dims`` hold at most ``max_bytes``.

    One Spark job for all of them: the sides are tagged, unioned and summed
    with partial aggregation, so every task ships one row per side and the
    driver receives one row per side.  (A ``limit(n + 1)`` probe would
    instead funnel up to n + 1 rows of every partition into a single task --
    billions of rows if a large table were passed by mistake.)
    """
    if not dims:
        return {}
    tagged = [df.select(F.lit(name).alias("_dim"), row_bytes(df).alias("_bytes")) for name, df in dims.items()]
    sizes = {r["_dim"]: r["n"] for r in
             reduce(DataFrame.unionAll, tagged).groupBy("_dim").agg(F.sum("_bytes").alias("n")).collect()}
    return {name: sizes.get(name, 0) <= max_bytes for name in dims}


def key_stats(sides: dict[str, tuple[DataFrame, str]]) -> dict[str, tuple[int, int, int]]:
    """Rows, distinct non-null keys and bytes of each side, one job for all.

    Two-level sums (per key, then per side), partial aggregation at both
    levels; a side whose first two numbers are equal has a unique, non-null
    key.
    """
    tagged = [df.select(F.lit(name).alias("_side"), F.col(key).cast("string").alias("_key"), row_bytes(df).alias("_bytes"))
              for name, (df, key) in sides.items()]
    per_key = reduce(DataFrame.unionAll, tagged).groupBy("_side", "_key").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("_bytes").alias("_b"))
    rows = per_key.groupBy("_side").agg(F.sum("_c").alias("n"), F.count("_key").alias("n_keys"),
                                        F.sum("_b").alias("bytes")).collect()
    got = {r["_side"]: (r["n"], r["n_keys"], r["bytes"]) for r in rows}
    return {name: got.get(name, (0, 0, 0)) for name in sides}


def left_join_spreading_nulls(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                              spread: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` for a left side whose
    key is often NULL.

    NULL keys never match, but in a shuffle join they all hash to one
    partition.  Joining on (key is null, coalesce(key, spread)) instead sends
    them wherever ``spread`` (a well-distributed column of the same type)
    hashes, while the null flag keeps them from matching any right row.
    """
    lk = F.col(left_key)
    l = left.select("*", lk.isNull().alias("_jk_null"), F.coalesce(lk, F.col(spread)).alias("_jk"))
    r = right.select("*", F.lit(False).alias("_rk_null"), F.col(right_key).alias("_rk"))
    return (l.join(r, (l["_jk_null"] == r["_rk_null"]) & (l["_jk"] == r["_rk"]), "left")
            .drop("_jk_null", "_jk", "_rk_null", "_rk"))


# A key with more than one in HOT_SHARE of the rows is hot; there are fewer than HOT_SHARE of them.
HOT_SHARE = 1000
GRID = 8


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """The keys that hold more than one in ``share`` rows of ``df``: fewer
    than ``share`` rows, so they may be broadcast.  Two passes over ``df``,
    with partial aggregation."""
    total = df.count()
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.where(F.col("_n") * share > total).select(key)


def join_splitting(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, grid: int = GRID) -> DataFrame:
    """``left INNER JOIN right USING (key)`` with the rows of ``hot`` keys
    (a bounded list) dealt over ``grid`` x ``grid`` cells.

    A hot key's left rows get a row number of the grid by their hash and go
    to every column of it, its right rows get a column and go to every row:
    each pair meets in one cell.  All other keys have one cell, so the join
    is on (key, row, column).  Adaptive execution can split a hot key only
    in a join that both sides are shuffled for, the first one of a chain;
    this also splits it in the later ones."""
    cells = reduce(DataFrame.unionAll, [hot.select(F.col(key).alias("_hot"), F.lit(i).alias("_to")) for i in range(grid)])

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        is_hot = F.col("_hot").isNotNull()
        by_hash = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(grid)).cast("int")
        return df.join(F.broadcast(cells), F.col(key) == F.col("_hot"), "left").select(
            *df.columns, F.when(is_hot, by_hash).otherwise(F.lit(0)).alias(own), F.coalesce("_to", F.lit(0)).alias(other))
    joined = dealt(left, "_row", "_col").join(dealt(right, "_col", "_row"), [key, "_row", "_col"])
    return joined.drop("_row", "_col")


def broadcast_if(df: DataFrame, bounded: bool) -> DataFrame:
    """Hint a side whose bound follows from an already checked one (e.g. a
    distinct projection of a checked dimension)."""
    return F.broadcast(df) if bounded else df
