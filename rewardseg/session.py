"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings the jobs are written for.  AQE re-plans joins at runtime
# (broadcast on measured size, skew-join splitting, partition coalescing).
# Static broadcast from plan *estimates* is off: a side is broadcast either
# because the job checked its row bound (operators.joins) or because AQE
# measured its materialised shuffle output below the adaptive threshold.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",  # sums of cents raise on overflow
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, input_tb: float) -> dict[str, str]:
    """Sizing for a cluster run: enough shuffle partitions that the largest
    shuffle (the compact line stream, about a third of the fact bytes) lands
    near 128 MB per partition before AQE coalesces small ones, scan splits of
    256 MB, and skew splitting for partitions five times the median."""
    line_stream_bytes = input_tb * 1e12 / 3
    partitions = max(4 * total_cores, int(line_stream_bytes / (128 * 1024 * 1024)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rewardseg", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a single machine) with no setting gets
    a fresh scratch folder; on a cluster a missing setting is an error, since
    a machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local-") or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="rewardseg-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured