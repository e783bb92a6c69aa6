"""Sinks: overwrite marker table, dated append snapshot, staged intermediates.

``replace_run`` publishes in two phases.  The run's rows are first written
whole into a folder of their own beside the published ones, in one whose
name starts with ``_``, so that no reader sees it.  Only then they take the
month's place: in a catalog table by pointing the partition at the new
folder, one change of the catalog; under a path by two renames.  A write that
fails leaves the old month as it was; a driver lost between the two renames
leaves it in ``_publish``, where ``read_run`` finds it and from where the
next publish (``repair``) puts it back.  Readers change nothing; one
publisher at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from rewardseg.session import ensure_checkpoint_dir


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def write_marker(df: DataFrame, target: str) -> None:
    """Full overwrite of the marker table (not a dynamic partition overwrite)."""
    writer = df.coalesce(1).write.mode("overwrite")
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def publish(df: DataFrame, target: str, mode: str = "append", partition_col: str = "update_date",
            run_date: dt.date | None = None) -> None:
    """Write the monthly snapshot partitioned by its run date.

    ``mode="append"`` adds the run's rows (a re-run of the same month
    duplicates them).  ``mode="replace_run"`` replaces the one partition of
    ``run_date``, with nothing if the run has no rows, and keeps every other
    month, which stays readable until the new rows are whole; it works the
    same for paths and catalog tables and changes no session setting.
    """
    if mode not in ("append", "replace_run"):
        raise ValueError(f"unknown publish mode {mode!r}")
    is_path = _is_path(target)
    spark = df.sparkSession
    if mode == "append" or not (is_path or spark.catalog.tableExists(target)):
        writer = df.write.partitionBy(partition_col).mode("append")
        return writer.parquet(target) if is_path else writer.saveAsTable(target)
    if run_date is None:
        raise ValueError("replace_run needs the run date whose rows it replaces")
    own = df.where(F.col(partition_col) == F.lit(run_date)).drop(partition_col)
    if is_path:
        _replace_folder(own, target, f"{partition_col}={run_date}")
    else:
        _replace_partition(own, target, partition_col, run_date)


WAITING = "_publish"     # holds what is being published or replaced


def _files(spark: SparkSession, *paths: str):
    """The file system of the first path, and the paths as it takes them."""
    found = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return found[0].getFileSystem(spark._jsc.hadoopConfiguration()), found


def _move(store, source, target) -> None:
    if not store.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def _replace_folder(own: DataFrame, target: str, month: str) -> None:
    """Write beside, then rename: the old month away, the new one in."""
    spark, waiting = own.sparkSession, f"{target}/{WAITING}"
    repair(spark, target)
    new = f"{waiting}/new-{uuid.uuid4().hex}"
    store, (at, old, fresh) = _files(spark, f"{target}/{month}", f"{waiting}/{month}", new)
    try:
        own.write.parquet(new)
        store.mkdirs(old.getParent())
        if store.exists(at):
            _move(store, at, old)
        _move(store, fresh, at)
        store.delete(old, True)
    finally:
        store.delete(fresh, True)


def repair(spark: SparkSession, target: str) -> list[str]:
    """Finish a publish under a path that was cut between its renames: a
    month that lies in the waiting folder and is missing from the target goes
    back, one that has its successor is deleted.  Returns the months put back."""
    store, (waiting,) = _files(spark, f"{target}/{WAITING}")
    back = []
    if not store.exists(waiting):
        return back
    for found in store.listStatus(waiting):
        name = found.getPath().getName()
        if name.startswith("new-"):
            continue
        _, (at,) = _files(spark, f"{target}/{name}")
        if store.exists(at):
            store.delete(found.getPath(), True)
        else:
            _move(store, found.getPath(), at)
            back.append(name)
    return back


def _replace_partition(own: DataFrame, target: str, partition_col: str, run_date: dt.date) -> None:
    """Write beside, then point the month's partition at the new folder."""
    spark, month = own.sparkSession, f"{partition_col} = DATE'{run_date}'"
    of_table = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {target}").collect()}
    store, (fresh,) = _files(spark, f"{of_table['Location']}/{WAITING}/{run_date}-{uuid.uuid4().hex}")
    columns = [c for c in spark.table(target).columns if c != partition_col]
    try:
        own.select(*columns).write.format(of_table.get("Provider", "parquet")).save(fresh.toString())
        had = [r for r in spark.sql(f"SHOW PARTITIONS {target}").collect() if r[0] == f"{partition_col}={run_date}"]
        if not had:
            spark.sql(f"ALTER TABLE {target} ADD PARTITION ({month}) LOCATION '{fresh.toString()}'")
            old = None
        else:
            detail = spark.sql(f"DESCRIBE FORMATTED {target} PARTITION ({month})").collect()
            at_partition = [r.col_name for r in detail].index("# Detailed Partition Information")
            old = next(r.data_type for r in detail[at_partition:] if r.col_name == "Location")
            spark.sql(f"ALTER TABLE {target} PARTITION ({month}) SET LOCATION '{fresh.toString()}'")
        spark.catalog.refreshTable(target)
    except Exception:
        store.delete(fresh, True)
        raise
    if old:
        store.delete(_files(spark, old)[1][0], True)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A catalog table bucketed and sorted on ``key`` (one file per bucket):
    joins and sums on it, with tables of as many buckets, need no shuffle."""
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_run(spark: SparkSession, target: str, run_date: dt.date, partition_col: str = "update_date") -> DataFrame:
    """The published rows of one run date; of a month that is just being
    replaced under a path, the old ones."""
    if _is_path(target):
        month = f"{partition_col}={run_date}"
        store, (at, old) = _files(spark, f"{target}/{month}", f"{target}/{WAITING}/{month}")
        if not store.exists(at) and store.exists(old):
            return spark.read.parquet(old.toString()).withColumn(partition_col, F.lit(run_date))
    table = spark.read.parquet(target) if _is_path(target) else spark.table(target)
    return table.where(F.col(partition_col) == F.lit(run_date))


def stage(df: DataFrame, name: str | None = None, how: str = "view") -> DataFrame:
    """Materialise an intermediate the way the run needs it.

    ``view``: register a temp view only (lazy, the default for single-use
    steps).  ``checkpoint``: reliable checkpoint into the cluster's shared
    ``spark.checkpoint.dir`` -- survives executor loss and cuts lineage, for
    intermediates read by several later steps.  ``cache``: memory-and-disk
    persist (recomputed from lineage if an executor is lost).
    """
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    elif how == "cache":
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    elif how != "view":
        raise ValueError(f"unknown staging {how!r}")
    if name:
        df.createOrReplaceTempView(name)
    return df
