"""Helpers shared by the operators: reading tables, staged tables, words."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rewardseg.session import ensure_checkpoint_dir

# A word of the contracts: a run of bytes outside space and \t \n \v \f \r.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_KEPT: dict = {}


def kept(kind, make):
    """A helper that a Python worker keeps between tasks (a vocabulary, a
    table).  A task that asks for another kind lets the last one go, so a
    reused worker holds one at a time."""
    if kind not in _KEPT:
        _KEPT.clear()
        _KEPT[kind] = make()
    return _KEPT[kind]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder under the cluster's shared
    checkpoint folder and read it back: lineage is cut, every executor can
    reread it after a loss, and later scans prune columns.  The folder goes
    when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def unstage(staged: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = staged.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(staged._staged_at)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fresh_name(name: str, taken) -> str:
    """``name`` with as many underscores before it as make it new."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, leaving every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_sizes(column) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def slices(sizes: np.ndarray, limit: int):
    """Consecutive (start, stop) runs whose sizes add up to about ``limit``
    (one oversized item makes a run of its own), so a task's working memory
    follows the limit and not the Arrow batch."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if len(sizes):
        yield start, len(sizes)
