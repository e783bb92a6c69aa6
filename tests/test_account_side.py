from pyspark.sql import functions as F

from rewardseg.operators.joins import hot_keys, join_splitting
from rewardseg.plans.pipeline import account_side


def test_rows_of_an_account_are_joined_and_not_gathered(spark):
    profile = spark.createDataFrame(
        [(1, age, "F", None, "A", points) for age in ("a", "b", None) for points in (5, None, *range(10, 200))] * 2 +
        [(2, "a", "M", "R", "A", 7), (None, "a", "M", "R", "A", 7), (3, "a", "M", "R", "A", 7)],
        "account_number long, age_band string, gender string, region string, acorn_category string, total_points long")
    segments = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (4, "x")], "account_number long, segment string")
    out = account_side(segments, profile)
    rows = [tuple(r) for r in out.collect()]
    want = [(1, "x", age, "F", None, "A", points) for age in ("a", "b", None) for points in (5, None, *range(10, 200))]
    assert sorted(map(str, rows)) == sorted(map(str, [*want, (2, "y", "a", "M", "R", "A", 7)]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "Generate" not in plan


def test_hot_account_is_split_in_both_joins(spark):
    """Half of 60,000 profile rows on one account: the cells of its joins
    spread over tasks, and the profile is read once."""
    from rewardseg.sources.staging import Staging
    staging = Staging(spark)
    hot = F.col("id") % 2 == 0
    profile = staging.write(spark.range(60_000).select(
        F.when(hot, 7).otherwise(F.col("id")).cast("long").alias("account_number"), (F.col("id") % 14).cast("string").alias("age_band"),
        F.lit("F").alias("gender"), F.lit("R").alias("region"), F.when(hot, F.col("id") % 3).cast("string").alias("acorn_category"),
        F.col("id").alias("total_points")), "profile")
    segments = staging.write(spark.range(60_000).select(F.col("id").alias("account_number"), F.lit("S").alias("segment")), "segments")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    reads = []

    def keep(df, name):
        reads.append((name, df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")))
        return staging.write(df, name)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = account_side(segments, profile, keep)
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        demographics = profile.select("account_number", "age_band", "acorn_category").distinct()
        want = profile.select("account_number", "total_points").distinct().join(demographics, "account_number").count()
        assert sum(per_task) == want == out.distinct().count()
        assert max(per_task) < 0.3 * want       # in one task it were over 0.9
        assert reads[0] == ("profiles", 1) and [n for n, _ in reads] == ["profiles", "hot-accounts"]
        assert str(profile.inputFiles()[0]).rsplit("/", 2)[-2] not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        staging.remove()


def test_splitting_join_equals_a_join(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 40 + [2, 3, None, 4])], "k long, a int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 30 + [2, 2, None, 5])], "k long, b int")
    hot = hot_keys(left, "k", share=10)
    assert [r.k for r in hot.collect()] == [1]
    for grid in (1, 3, 8):
        got = join_splitting(left, right, "k", hot, grid)
        assert got.columns == ["k", "a", "b"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
