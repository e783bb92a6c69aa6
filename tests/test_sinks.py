"""Snapshot append vs re-run-safe publish, marker overwrite, staging."""

import datetime as dt
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from rewardseg.sources import publish, sinks, stage, write_marker
from rewardseg.sources.staging import Staging


def _snap(spark, day, n):
    return spark.createDataFrame([(i, day) for i in range(n)], "pi_entity_fk long, update_date date")


def test_append_twice_doubles(spark):
    out = tempfile.mkdtemp(prefix="rewardseg-sink-") + "/snap"
    d = dt.date(2000, 12, 31)
    publish(_snap(spark, d, 3), out)
    publish(_snap(spark, d, 3), out)
    assert spark.read.parquet(out).count() == 6


@pytest.mark.parametrize("kind", ["path", "table"])
def test_replace_run_keeps_other_months(spark, kind):
    name = f"snap_{uuid.uuid4().hex}"
    out = tempfile.mkdtemp(prefix="rewardseg-sink-") + "/snap" if kind == "path" else name
    read = (lambda: spark.read.parquet(out)) if kind == "path" else (lambda: spark.table(out))
    nov, dec = dt.date(2000, 11, 30), dt.date(2000, 12, 31)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def counts():
        if kind == "table":
            spark.catalog.refreshTable(out)
        return {r["update_date"]: r["count"] for r in read().groupBy("update_date").count().collect()}
    try:
        publish(_snap(spark, nov, 2), out)
        publish(_snap(spark, dec, 3), out)
        for n in (3, 5, 0, 4):  # a re-run, a larger one, an empty one, and one after it
            publish(_snap(spark, dec, n), out, mode="replace_run", run_date=dec)
            assert counts() == ({nov: 2, dec: n} if n else {nov: 2})
        assert sorted(r["pi_entity_fk"] for r in read().where(F.col("update_date") == dec).collect()) == [0, 1, 2, 3]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
        with pytest.raises(ValueError):
            publish(_snap(spark, dec, 1), out, mode="replace_run")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("kind", ["path", "table"])
def test_a_broken_write_keeps_the_old_month(spark, kind):
    name = f"snap_{uuid.uuid4().hex}"
    out = tempfile.mkdtemp(prefix="rewardseg-sink-") + "/snap" if kind == "path" else name
    nov, dec = dt.date(2000, 11, 30), dt.date(2000, 12, 31)
    rows = lambda: sorted(tuple(r) for r in (spark.read.parquet(out) if kind == "path" else spark.table(out)).collect())
    try:
        publish(_snap(spark, nov, 2), out)
        publish(_snap(spark, dec, 3), out)
        before = rows()
        # some tasks write whole files before another one fails
        broken = spark.range(0, 4000, 1, 8).select(
            F.when(F.col("id") == 3999, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("pi_entity_fk"),
            F.lit(dec).alias("update_date"))
        with pytest.raises(Exception, match="lost"):
            publish(broken, out, mode="replace_run", run_date=dec)
        assert rows() == before
        publish(_snap(spark, dec, 1), out, mode="replace_run", run_date=dec)
        assert [r for r in rows() if r[1] == dec] == [(0, dec)] and len(rows()) == 3
        publish(_snap(spark, dec, 2), out)      # and it is appended to as before
        assert len(rows()) == 5
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_publish_cut_between_its_renames_is_repaired(spark):
    out, dec = tempfile.mkdtemp(prefix="rewardseg-sink-") + "/snap", dt.date(2000, 12, 31)
    publish(_snap(spark, dt.date(2000, 11, 30), 2), out)
    publish(_snap(spark, dec, 3), out)
    store, (at, away, parent) = sinks._files(spark, f"{out}/update_date={dec}", f"{out}/{sinks.WAITING}/update_date={dec}", f"{out}/{sinks.WAITING}")
    store.mkdirs(parent)
    assert store.rename(at, away)
    found = sinks.read_run(spark, out, dec)                     # the reader finds it there
    assert sorted(map(tuple, found.select("pi_entity_fk", "update_date").collect())) == [(i, dec) for i in range(3)]
    assert sinks.repair(spark, out) == [f"update_date={dec}"] and store.exists(at)
    store.mkdirs(away)                                          # the new month is in, the old one still there
    assert sinks.repair(spark, out) == [] and not store.exists(away)
    assert sinks.read_run(spark, out, dec).count() == 3


def test_first_publish_of_a_table_may_replace(spark):
    name, day = f"snap_{uuid.uuid4().hex}", dt.date(2000, 12, 31)
    try:
        publish(_snap(spark, day, 2), name, mode="replace_run", run_date=day)
        assert spark.table(name).count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_staging_folder_goes_with_the_run(spark):
    staging = Staging(spark)
    df = staging.write(_snap(spark, dt.date(2000, 1, 1), 5).where("pi_entity_fk > 1"), "rows")
    assert df.count() == 3 and "Scan parquet" in df._jdf.queryExecution().executedPlan().toString()
    folder = spark._jvm.org.apache.hadoop.fs.Path(staging.path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert store.exists(folder)
    staging.remove()
    assert not store.exists(folder)


def test_marker_overwrites(spark):
    out = tempfile.mkdtemp(prefix="rewardseg-sink-") + "/marker"
    write_marker(_snap(spark, dt.date(2000, 1, 1), 4), out)
    write_marker(_snap(spark, dt.date(2000, 2, 1), 2), out)
    assert spark.read.parquet(out).count() == 2


def test_checkpoint_stage_cuts_lineage(spark):
    df = stage(_snap(spark, dt.date(2000, 1, 1), 5).where("pi_entity_fk > 1"), "staged", how="checkpoint")
    assert df.count() == 3
    assert spark.table("staged").count() == 3
