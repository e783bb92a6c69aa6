"""Whole-run behaviour: publish, determinism across partitionings, invariants."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rewardseg import fixed_values as fv
from rewardseg.operators import bands, linking
from rewardseg.params import TEST_PARAMS
from rewardseg.plans.pipeline import SNAPSHOT_COLUMNS, publish_run
from rewardseg.plans.registry import make_run
from rewardseg.session import ensure_checkpoint_dir
from rewardseg.sources import testdata_sources as derive_sources


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_publish_run_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="rewardseg-pub-")
    folder = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    before = {str(f.getPath().getName()) for f in files.listStatus(folder)}
    src = derive_sources(spark, SF_SMALL, TEST_PARAMS)
    snap = publish_run(src, TEST_PARAMS, f"{root}/snapshot", f"{root}/marker")
    written = spark.read.parquet(f"{root}/snapshot")
    assert set(written.columns) == set(SNAPSHOT_COLUMNS)
    first = _rows(written.select(*SNAPSHOT_COLUMNS))
    assert first == _rows(snap.select(*SNAPSHOT_COLUMNS)) and first
    assert spark.read.parquet(f"{root}/marker").count() >= 1
    publish_run(src, TEST_PARAMS, f"{root}/snapshot", f"{root}/marker", mode="replace_run")
    again = spark.read.parquet(f"{root}/snapshot")
    assert _rows(again.select(*SNAPSHOT_COLUMNS)) == first
    left = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    store = left.getFileSystem(spark._jsc.hadoopConfiguration())
    runs = {str(f.getPath().getName()) for f in store.listStatus(left)}
    assert not {r for r in runs if r.startswith("run-")} - before, "staged tables of a finished run stay"


def test_same_result_for_any_shuffle_partitioning(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    out = []
    try:
        for parts in ("1", "7"):
            spark.conf.set(key, parts)
            run = make_run(spark, SF_SMALL, staging="view")
            long = bands.spend_long(run.category_spend())
            out.append((_rows(run.snapshot),
                        _rows(bands.ntile_bands(long, n=5, max_groups=len(fv.CATEGORY_NAMES))),
                        _rows(linking.link_rank(run.link_account, 1))))
    finally:
        spark.conf.set(key, before)
    assert out[0] == out[1]


def test_invariants(spark):
    run = make_run(spark, SF_SMALL, staging="view")
    # one segment per account
    assert run.segments.groupBy("account_number").count().where("count > 1").count() == 0
    # category sums never exceed the total when the entity has no negative line
    neg = run.items.where(F.col("line_total") < 0).select("pi_entity_fk").distinct()
    cat = run.category_spend().join(neg, "pi_entity_fk", "left_anti")
    summed = sum(F.col(c) for c in fv.SPEND_COLUMNS)
    assert cat.where(summed > F.col("total_spend")).count() == 0
    # snapshot accounts come from both streams
    snap_accounts = run.snapshot.select("account_number").distinct()
    assert snap_accounts.join(run.segments, "account_number", "left_anti").count() == 0
    assert snap_accounts.join(run.link_account, "account_number", "left_anti").count() == 0
    # the loyalty hash never reaches the snapshot
    assert "loyalty_card_hash" not in run.snapshot.columns
