"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

smallest test tables (JVM, code generation), then three repetitions at the
target scale with the ``noop`` sink (every row produced, nothing collected
to the driver); the median per query is reported.  Every repetition of a
query computes it from the tables: no run, staged table or result is shared
between queries.  ``shuffle_mb`` and ``rows`` are those of one repetition,
from the event log and an observed count.  ``duckdb`` is the time of the
oracle SQL of the same query on the same tables and cores, as a yardstick.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Observation, functions as F  # noqa: E402

from rewardseg.plans.oracle import oracle_queries  # noqa: E402
from rewardseg.plans.registry import QUERIES  # noqa: E402
from rewardseg.session import build_session  # noqa: E402

HEADLINE = (
    "snapshot",
    "segment_counts",
    "profile_base",
    "item_base",
    "online_loyalty",
    "entity_spend",
    "category_spend",
    "retail_profile",
    "link_account",
    "link_rank",
    "ntile_bands",
)
WARMUP_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def run(spark, name: str, sf_dir: str) -> tuple[float, int]:
    seen = Observation()
    spark.sparkContext.setJobDescription(name)
    t = time.perf_counter()
    df = QUERIES[name](spark, sf_dir).observe(seen, F.count(F.lit(1)).alias("rows"))
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t, seen.get["rows"]


def shuffle_mb(log_dir: str, since_ms: float) -> dict[str, float]:
    """Shuffle bytes written per job description, from the event log."""
    query, mb = {}, defaultdict(float)
    for path in Path(log_dir).iterdir():
        for line in path.open(errors="replace"):
            try:
                event = json.loads(line)
            except ValueError:
                continue
            if event["Event"] == "SparkListenerJobStart" and event.get("Submission Time", 0) >= since_ms:
                name = (event.get("Properties") or {}).get("spark.job.description")
                query.update({stage: name for stage in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in query:
                write = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                mb[query[event["Stage ID"]]] += write.get("Shuffle Bytes Written", 0) / 1e6
    return mb


def duckdb_seconds(names, sf_dir: str, cpus: int) -> dict[str, float]:
    import duckdb
    con = duckdb.connect(config={"threads": cpus})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    sql, out = oracle_queries(), {}
    for name in names:
        times = []
        for _ in range(3):
            t = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE bench_out AS {sql[name]}")
            times.append(time.perf_counter() - t)
        out[name] = round(statistics.median(times), 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    log_dir = tempfile.mkdtemp(prefix="rewardseg-bench-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, extra={
        "spark.driver.memory": "16g", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    if Path(WARMUP_DIR).exists():
        for name in names:
            run(spark, name, WARMUP_DIR)
    samples: dict[str, list[float]] = {name: [] for name in names}
    rows: dict[str, int] = {}
    last = 0.0
    for _ in range(reps):
        last = time.time() * 1000
        for name in names:
            seconds, rows[name] = run(spark, name, sf_dir)
            samples[name].append(seconds)
    version = spark.version
    spark.stop()  # ends the event log
    moved = shuffle_mb(log_dir, last)
    times = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rows": rows,
                      "shuffle_mb": {n: round(moved.get(n, 0.0), 2) for n in names},
                      "duckdb": duckdb_seconds(names, sf_dir, cpus),
                      "cores": cpus, "driver_memory": "16g", "spark": version,
                      "sf": float(sf) if sf else sf_dir}))


if __name__ == "__main__":
    main()
