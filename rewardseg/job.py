"""The monthly job as a program.

    spark-submit --py-files rewardseg.zip rewardseg/job.py --as-of 2000-12-31 --start-year 1996 \\
        --sources sources.json --snapshot db.reward_snapshot --marker db.week_marker --mode replace_run

``sources.json`` holds ``{"tables": {source: table}}`` or ``{"root": folder}``
and, where a table has column names of its own,
``{"columns": {source: {contract column: its name}}}``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from rewardseg.params import RunParams
from rewardseg.plans.pipeline import publish_run
from rewardseg.session import build_session
from rewardseg.sources import Sources


def read_sources(spark, config: dict) -> Sources:
    columns = config.get("columns")
    if "tables" in config:
        return Sources.from_tables(spark, config["tables"], columns)
    return Sources.from_parquet(spark, config["root"], columns=columns)


def main(argv: list[str] | None = None) -> int:
    ask = argparse.ArgumentParser(description="Segment reward customers and publish one monthly snapshot.")
    ask.add_argument("--as-of", type=dt.date.fromisoformat, required=True, help="run date, end of the history")
    ask.add_argument("--start-year", type=int, required=True)
    ask.add_argument("--sources", required=True, help="JSON file with the source mapping")
    ask.add_argument("--snapshot", required=True, help="table or path of the snapshot")
    ask.add_argument("--marker", required=True, help="table or path of the week marker")
    ask.add_argument("--mode", choices=("append", "replace_run"), default="append")
    ask.add_argument("--supplier-code", default=RunParams.supplier_code)
    got = ask.parse_args(argv)
    spark = build_session(app_name="rewardseg-job")
    with open(got.sources) as f:
        src = read_sources(spark, json.load(f))
    params = RunParams(as_of=got.as_of, start_year=got.start_year, supplier_code=got.supplier_code)
    rows = publish_run(src, params, got.snapshot, got.marker, mode=got.mode).count()
    print(f"published {rows} rows for {got.as_of}")
    return rows


if __name__ == "__main__":
    main()
