"""NTILE spend bands per category, distributed.

``ntile(n) OVER (PARTITION BY category ORDER BY spend, entity)`` puts every
row of a category in one task.  With 11 categories that is 11 tasks for the
whole customer base.  The distributed form computes the same tile from a
global row number:

1. range-partition the long (category, spend, entity) rows on that full
   sort key -- a hot category or a hot spend value (zero spend) spreads over
   many partitions because the entity key breaks the ties;
2. sort inside each range partition on the same key, take each row's
   position there (``monotonically_increasing_id`` after a total-order
   local sort: consecutive within a partition) and stage the numbered rows,
   so that both readers below see the same partitions whatever the planner
   does with exchanges; the first position and the row count of every
   (category, partition) piece come from a small aggregation over them;
3. per category, add the row counts of the earlier pieces (a window over
   the small piece-count table, one row per piece) and the category total;
4. tile from (row number, total, n): the first ``total mod n`` tiles hold
   one extra row, exactly as NTILE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rewardseg import fixed_values as fv
from rewardseg.operators.joins import broadcast_if
from rewardseg.sources.staging import Staging

# Four columns of at most 40 bytes together: 200 MB at this many rows.
OFFSET_BROADCAST_ROWS = 5_000_000


def spend_long(cat_spend: DataFrame) -> DataFrame:
    """(pi_entity_fk, category, spend) -- one row per entity and category."""
    pairs = ", ".join(f"'{name}', `{col}`" for name, col in zip(fv.CATEGORY_NAMES, fv.SPEND_COLUMNS))
    return cat_spend.selectExpr("pi_entity_fk",
                                f"stack({len(fv.CATEGORY_NAMES)}, {pairs}) as (category, spend)")


def _tile(rn, total, n: int):
    """NTILE of 1-based row ``rn`` among ``total`` rows."""
    base = F.floor(total / n).cast("bigint")
    rem = (total % n).cast("bigint")
    big = rem * (base + 1)
    return (F.when(rn <= big, F.floor((rn - 1) / (base + 1)) + 1)
            .otherwise(rem + F.floor((rn - 1 - big) / F.greatest(base, F.lit(1))) + 1)).cast("int")


def ntile_bands(long: DataFrame, n: int = 5, key: str = "pi_entity_fk", value: str = "spend",
                group: str = "category", partitions: int | None = None,
                max_groups: int | None = None, staging: Staging | None = None) -> DataFrame:
    """Distributed NTILE; same result as ``F.ntile(n)`` over
    ``partitionBy(group).orderBy(value, key)`` when ``key`` is unique per group.

    Pieces are runs of one group inside consecutive range partitions, so the
    piece-offset table has at most (range partitions + groups - 1) rows; with
    a known ``max_groups`` that bound is proven and it is broadcast, else
    the join is left to AQE (broadcast on measured size).  Runs eagerly up
    to the staged rows."""
    spark = long.sparkSession
    staging = staging or Staging(spark)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(group), F.col(value).asc_nulls_first(), F.col(key).asc_nulls_first()]
    numbered = (long.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                .withColumn("_piece", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    numbered = staging.write(numbered, "ntile")
    pieces = numbered.groupBy(group, "_piece").agg(F.count(F.lit(1)).alias("_cnt"),
                                                    F.min("_pos").alias("_first"))
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    offsets = pieces.select(group, "_piece", "_first",
                            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
                            F.sum("_cnt").over(whole).alias("_total"))
    offsets = broadcast_if(offsets, max_groups is not None and parts + max_groups - 1 <= OFFSET_BROADCAST_ROWS)
    out = numbered.join(offsets, [group, "_piece"], "inner")
    rn = F.col("_offset") + (F.col("_pos") - F.col("_first")) + 1
    return out.select(*[c for c in long.columns], _tile(rn, F.col("_total"), n).alias(f"{value}_ntile"))


# -- tiles from their last rows -------------------------------------------------

GRID = 64                # probes of a bracket in one pass
COLLECT_ROWS = 500       # a bracket of fewer rows is read whole
ACCURACY = 10_000


def _probe_counts(rows: DataFrame, brackets: DataFrame, probes: dict[int, list], measure: str, dtype) -> dict:
    """Exact rows of each bracket around its probes: (id, probes below the
    row, the row equals one) -> rows."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(i, p) for i, p in probes.items()], T.StructType(
        [T.StructField("_id", T.IntegerType()), T.StructField("_probes", T.ArrayType(dtype))]))
    found = rows.join(F.broadcast(brackets.join(table, "_id")), _in_bracket(measure))
    below = F.size(F.filter("_probes", lambda p: p < F.col(measure)))
    counts = found.groupBy("_id", below.alias("_below"), F.array_contains("_probes", F.col(measure)).alias("_equal")).count()
    return {(r["_id"], r["_below"], r["_equal"]): r["count"] for r in counts.collect()}


def _in_bracket(measure: str) -> Column:
    m = F.col(measure)
    return (F.col("_group").eqNullSafe(F.col("_of")) & (~F.col("_tied") | F.col("_value").eqNullSafe(F.col("_at"))) & m.isNotNull()
            & (F.col("_lo").isNull() | (m > F.col("_lo"))) & (F.col("_hi").isNull() | (m < F.col("_hi"))))


def _select_ranks(rows: DataFrame, cuts: list[dict], measure: str, tied: bool) -> None:
    """For each cut, the ``rank``-th (from 1) of its rows in order of
    ``measure``: ``found``, and ``before``, how many of them are smaller.

    A cut's rows are those of its group (``tied``: that have its value too).
    Each pass takes quantiles of what is left of every cut's bracket, counts
    the rows around them exactly and keeps the interval that holds the rank,
    so a bracket shrinks by about ``GRID`` a pass without any row moving."""
    spark, types = rows.sparkSession, {f.name: f.dataType for f in rows.schema.fields}
    dtype = types[measure]
    shape = T.StructType([T.StructField("_id", T.IntegerType()), T.StructField("_of", types["_group"]), T.StructField("_tied", T.BooleanType()),
                          T.StructField("_at", types["_value"]), T.StructField("_lo", dtype), T.StructField("_hi", dtype)])
    open_cuts = {i: c for i, c in enumerate(cuts)}
    for c in cuts:
        c.update(lo=None, hi=None, before=0)
    while open_cuts:
        brackets = spark.createDataFrame([(i, c["group"], tied, c.get("value"), c["lo"], c["hi"]) for i, c in open_cuts.items()], shape)
        found = rows.join(F.broadcast(brackets), _in_bracket(measure))
        # at most GRID + 1 values a bracket; accurate to one in ACCURACY of its rows
        seen = found.groupBy("_id").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(
            measure, [i / GRID for i in range(GRID + 1)], ACCURACY).alias("q")).collect()
        small = [r["_id"] for r in seen if r["n"] <= COLLECT_ROWS]
        if small:
            read = {}
            for r in found.where(F.col("_id").isin(small)).select("_id", measure).collect():   # at most COLLECT_ROWS a cut
                read.setdefault(r[0], []).append(r[1])
            for i in small:
                c = open_cuts.pop(i)
                values = sorted(read[i])
                c["found"] = values[c["rank"] - c["before"] - 1]
                c["before"] += sum(v < c["found"] for v in values)
                c["equal"] = sum(v == c["found"] for v in values)
        probes = {r["_id"]: sorted(set(r["q"])) for r in seen if r["_id"] in open_cuts}
        if not probes:
            continue
        counts = _probe_counts(rows, brackets, probes, measure, dtype)
        for i, values in probes.items():
            c = open_cuts[i]
            lo = c["lo"]
            for j, v in enumerate(values):
                c["before"] += counts.get((i, j, False), 0)          # between the probe before and this one
                here = counts.get((i, j, True), 0)
                if c["rank"] <= c["before"]:
                    c["before"] -= counts.get((i, j, False), 0)
                    c["lo"], c["hi"] = lo, v
                    break
                if c["rank"] <= c["before"] + here:
                    c["found"], c["equal"] = v, here
                    del open_cuts[i]
                    break
                c["before"] += here
                lo = v
            else:
                c["lo"] = lo


def tile_cuts(long: DataFrame, n: int, key: str = "pi_entity_fk", value: str = "spend", group: str = "category",
              max_groups: int = 1000) -> list[dict]:
    """The last row of each tile but the last: per group and cut the group,
    its ``value`` and ``key``.  Only counts and quantiles reach the driver:
    the groups are few (``max_groups``, checked), with n - 1 cuts each."""
    rows = long.select(F.col(group).alias("_group"), F.col(value).alias("_value"), F.col(key).alias("_key"))
    totals = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_value").isNull()).alias("empty")).limit(max_groups + 1).collect()
    if len(totals) > max_groups:
        raise ValueError(f"more than {max_groups} groups: use ntile_bands")
    cuts = []
    for r in totals:
        for i in range(1, n):
            rank = i * (r["n"] // n) + min(i, r["n"] % n)
            if rank < r["n"]:
                cuts.append({"group": r["_group"], "cut": i, "overall": rank, "empty": r["empty"]})
    # the value of each cut (NULL first), then its key among the rows of that value
    valued = [c for c in cuts if c["overall"] > c["empty"]]
    for c in valued:
        c["rank"] = c["overall"] - c["empty"]
    _select_ranks(rows, valued, "_value", tied=False)
    for c in cuts:
        c["value"] = c.get("found") if c["overall"] > c["empty"] else None
        c["rank"] = c["overall"] - c["empty"] - c["before"] if c["overall"] > c["empty"] else c["overall"]
    keyless = rows.where(F.col("_key").isNull()).groupBy("_group", "_value").count()
    keyless = {(r["_group"], r["_value"]): r["count"] for r in keyless.limit(max_groups * n).collect()} if cuts else {}
    tied = []
    for c in cuts:
        c.pop("found", None)
        c["rank"] -= keyless.get((c["group"], c["value"]), 0)
        if c["rank"] > 0:
            tied.append(c)
    _select_ranks(rows, tied, "_key", tied=True)
    return [{"group": c["group"], "cut": c["cut"], "value": c["value"], "key": c.get("found")} for c in cuts]


def ntile_by_cuts(long: DataFrame, n: int = 5, key: str = "pi_entity_fk", value: str = "spend", group: str = "category",
                  max_groups: int = 1000) -> DataFrame:
    """``ntile_bands`` without sorting or shuffling the rows: the last row of
    every tile is found by counting passes, and a row's tile is one more than
    the number of cuts that lie before it.  For a ``long`` that is cheap to
    read again (staged); same result for keys unique per group."""
    types = {f.name: f.dataType for f in long.schema.fields}
    per_group: dict = {}
    for c in tile_cuts(long, n, key, value, group, max_groups):
        per_group.setdefault(c["group"], []).append((c["value"], c["key"]))
    table = long.sparkSession.createDataFrame(list(per_group.items()), T.StructType([
        T.StructField("_of", types[group]), T.StructField("_cuts", T.ArrayType(T.StructType([T.StructField("v", types[value]), T.StructField("k", types[key])])))]))

    def after(cut):
        def later(a, b):   # a in front of b, NULL first
            return F.coalesce(a < b, a.isNull() & b.isNotNull())
        return later(cut["v"], F.col(value)) | (cut["v"].eqNullSafe(F.col(value)) & later(cut["k"], F.col(key)))
    marked = long.join(F.broadcast(table), F.col(group).eqNullSafe(F.col("_of")), "left")
    tile = F.when(F.col("_cuts").isNull(), 1).otherwise(1 + F.size(F.filter("_cuts", after)))
    return marked.select(*long.columns, tile.cast("int").alias(f"{value}_ntile"))


def positive_ntile_bands(long: DataFrame, n: int = 5, **options) -> DataFrame:
    """NTILE over spenders only: spend of 0 is a band of its own (1) and the
    positive spends of a category are tiled into bands 2 to n + 1; negative
    spend has no band.  An inference from the fixed ladders, which treat
    zero and returns this way."""
    tiled = ntile_bands(long.where("spend > 0"), n, **options)
    rest = long.where("spend <= 0 or spend is null").select(
        *long.columns, F.when(F.col("spend") == 0, 1).cast("int").alias("spend_ntile"))
    return tiled.withColumn("spend_ntile", F.col("spend_ntile") + 1).unionByName(rest)


def ntile_bands_reference(long: DataFrame, n: int = 5, key: str = "pi_entity_fk",
                          value: str = "spend", group: str = "category") -> DataFrame:
    """Plain window NTILE (one task per group); used to test the distributed form."""
    w = Window.partitionBy(group).orderBy(F.col(value).asc_nulls_first(), F.col(key).asc_nulls_first())
    return long.withColumn(f"{value}_ntile", F.ntile(n).over(w))
