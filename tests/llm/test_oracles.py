"""Queries that SQL can state, against DuckDB."""

import pytest

from parity import check, duck

from rewardseg.llm.registry import ORACLE_SQL

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duck(SF)
    for t in ("documents", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = check(spark, con, name, SF)
    assert got == want
