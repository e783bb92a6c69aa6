"""Join helpers: NULL-key spreading left join, size statistics."""

from pyspark.sql import functions as F

from rewardseg.operators.joins import bounded_sizes, key_stats, left_join_spreading_nulls


def test_left_join_spreading_nulls_equals_plain_left_join(spark):
    left = spark.createDataFrame([(i, None if i % 3 else i % 7) for i in range(300)] + [(1000, 3), (1001, 3)],
                                 "id long, k long")
    right = spark.createDataFrame([(3, "a"), (3, "b"), (0, "c"), (99, "d")], "pk long, v string")
    got = left_join_spreading_nulls(left, right, "k", "pk", spread="id")
    ref = left.join(right, left.k == right.pk, "left")
    assert sorted(map(tuple, got.select("id", "k", "pk", "v").collect())) == \
        sorted(map(tuple, ref.select("id", "k", "pk", "v").collect()))


def test_key_stats_detects_duplicates_and_nulls(spark):
    uniq = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    nul = spark.createDataFrame([(1,), (None,)], "k long")
    assert key_stats({"u": (uniq, "k"), "d": (dup, "k"), "n": (nul, "k")}) == \
        {"u": (3, 3, 48), "d": (3, 2, 48), "n": (2, 1, 32)}


def test_broadcast_bound_counts_bytes_not_rows(spark):
    narrow = spark.range(1000).select("id")
    wide = spark.range(10).select("id", F.expr("repeat('x', 5000)").alias("s"))
    assert bounded_sizes({"narrow": narrow, "wide": wide}, max_bytes=20_000) == {"narrow": True, "wide": False}


def test_cluster_sizing_targets_128mb_shuffle_partitions():
    from rewardseg.session import cluster_conf
    conf = cluster_conf(total_cores=8000, input_tb=100)
    parts = int(conf["spark.sql.shuffle.partitions"])
    # a third of 100 TB in ~128 MiB partitions, never fewer than 4 per core
    assert 200_000 <= parts <= 300_000 and parts >= 4 * 8000
    assert int(cluster_conf(8, 0.0001)["spark.sql.shuffle.partitions"]) == 32
