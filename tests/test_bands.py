"""Distributed NTILE equals the window NTILE, including ties and skew."""

import random

import pytest
from pyspark.sql import functions as F

from rewardseg.operators import bands
from rewardseg.operators.bands import ntile_bands, ntile_bands_reference, positive_ntile_bands


def _long(spark, n_rows, seed):
    rng = random.Random(seed)
    rows = []
    for key in range(n_rows):
        group = "hot" if key % 3 == 0 else rng.choice(["a", "b", "c"])
        # a third of the values are 0 (the hot value), the rest have many ties
        value = 0 if rng.random() < 0.33 else rng.randrange(0, 50)
        rows.append((key, group, value))
    return spark.createDataFrame(rows, "pi_entity_fk long, category string, spend long")


def _tiles(df):
    return sorted((r["pi_entity_fk"], r["category"], r["spend_ntile"]) for r in df.collect())


@pytest.mark.parametrize("n,parts", [(5, 8), (4, 1), (7, 13), (100, 3)])
def test_distributed_ntile_matches_window(spark, n, parts):
    long = _long(spark, 2000, seed=n)
    assert _tiles(ntile_bands(long, n=n, partitions=parts, max_groups=4)) == \
        _tiles(ntile_bands_reference(long, n=n))


def test_fewer_rows_than_tiles(spark):
    long = spark.createDataFrame([(1, "g", 5), (2, "g", 3), (3, "h", 1)],
                                 "pi_entity_fk long, category string, spend long")
    assert _tiles(ntile_bands(long, n=5, partitions=4)) == _tiles(ntile_bands_reference(long, n=5))


@pytest.mark.parametrize("setting", [{}, {"spark.sql.exchange.reuse": "false"}, {"spark.sql.adaptive.enabled": "false"}])
def test_tiles_do_not_depend_on_exchange_reuse(spark, setting):
    """Over a million rows with ties, an extra column, whatever the planner reuses."""
    rows = spark.range(1_200_000).select(
        F.col("id").alias("pi_entity_fk"), F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("category"),
        F.when(F.col("id") % 5 < 2, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("spend"),
        F.md5(F.col("id").cast("string")).alias("extra"))
    before = {k: spark.conf.get(k) for k in setting if spark.conf.get(k, None) is not None}
    try:
        for k, v in setting.items():
            spark.conf.set(k, v)
        got = ntile_bands(rows, n=7, partitions=9, max_groups=3)
        want = ntile_bands_reference(rows.drop("extra"), n=7).withColumnRenamed("spend_ntile", "want")
        joined = got.join(want, ["pi_entity_fk", "category", "spend"])
        assert joined.count() == 1_200_000 and joined.where("spend_ntile <> want").count() == 0
        assert got.columns == ["pi_entity_fk", "category", "spend", "extra", "spend_ntile"]
    finally:
        for k in setting:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_spenders_are_tiled_apart_from_zero_and_returns(spark):
    long = spark.createDataFrame([(i, "g", s) for i, s in enumerate([0, 0, 0, -5, 1, 2, 3, 4, None])],
                                 "pi_entity_fk long, category string, spend long")
    got = {r["pi_entity_fk"]: r["spend_ntile"] for r in positive_ntile_bands(long, n=2, partitions=3).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: None, 4: 2, 5: 2, 6: 3, 7: 3, 8: None}


def test_tiles_by_cuts_equal_window_ntile(spark):
    """Ties, NULL spend, NULL keys, tiny groups and a NULL group; small brackets make many passes."""
    rows = []
    for g, size, spends in (("a", 3000, 4), ("b", 1500, 1), ("c", 3, 2), (None, 700, 60), ("d", 5, 5), ("e", 1, 1), ("f", 900, 900)):
        rows += [(i * 7919 % 100_003, g, None if i % 11 == 0 and g != "e" else (i * 31) % spends) for i in range(size)]
    rows += [(None, "a", 1), (None, "f", None)]
    long = spark.createDataFrame(rows, "pi_entity_fk long, category string, spend int").repartition(5)
    for n in (1, 2, 5, 7):
        got, want = bands.ntile_by_cuts(long, n), bands.ntile_bands_reference(long, n)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert bands.ntile_by_cuts(long.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        bands.ntile_by_cuts(long, 5, max_groups=3)


def test_tiles_by_cuts_of_a_million_tied_rows(spark):
    """A million rows, most of them tied, in two groups: equal tiles, and no row is shuffled."""
    from rewardseg.sources.staging import Staging
    staging = Staging(spark)
    long = staging.write(spark.range(0, 1_000_000, 1, 8).select(
        ((F.col("id") * 48271) % 1_000_003).alias("pi_entity_fk"), F.when(F.col("id") % 10 < 7, "hot").otherwise("other").alias("category"),
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 1000).cast("decimal(18,2)").alias("spend")), "long")
    got = bands.ntile_by_cuts(long, 5)
    counts = got.groupBy("category", "spend_ntile").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("spend", "pi_entity_fk")).alias("lo"),
                                                        F.max(F.struct("spend", "pi_entity_fk")).alias("hi"))
    want = bands.ntile_bands_reference(long, 5).groupBy("category", "spend_ntile").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("spend", "pi_entity_fk")).alias("lo"), F.max(F.struct("spend", "pi_entity_fk")).alias("hi"))
    assert sorted(map(str, counts.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan and "Sort" not in plan
    staging.remove()
