"""Staged tables of a run: Parquet in a folder of its own on shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rewardseg.session import ensure_checkpoint_dir


class Staging:
    """One run's folder under the cluster's ``spark.checkpoint.dir``.

    ``write`` materialises a frame there once and reads it back: lineage is
    cut, an executor loss later on rereads it, and readers prune columns.
    ``remove`` deletes the folder when the run is over; a run that never
    gets there loses it when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._store = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        self._store.deleteOnExit(self._folder)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        self._store.delete(self._folder, True)
