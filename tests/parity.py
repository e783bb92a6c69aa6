"""Spark-vs-DuckDB parity check: row count, column names, order-free value hash.

Usable from pytest and from the command line:
    python tests/parity.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def digest(columns, rows) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(lines), names, h


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def oracle_digest(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return digest(cols, cur.fetchall())


def spark_digest(df):
    return digest(df.columns, [tuple(r) for r in df.collect()])


def check(spark, con, name: str, sf_dir: str):
    import __spark_entry__ as entry
    s = spark_digest(entry.queries()[name](spark, sf_dir))
    o = oracle_digest(con, entry.oracle_sql()[name])
    return s, o


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from rewardseg.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    names = argv[1:] or list(entry.oracle_sql())
    bad = 0
    for name in names:
        t = time.time()
        try:
            s, o = check(spark, con, name, sf_dir)
        except Exception as e:  # report and go on
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:600]}", flush=True)
            bad += 1
            continue
        ok = s == o
        bad += not ok
        detail = "" if ok else f"\n   spark={s[0]} {s[1]}\n   duck ={o[0]} {o[1]}"
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={s[0]:6d} {time.time() - t:5.1f}s{detail}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
