"""Every registered query against its DuckDB oracle (sf0.001; the driver
repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from parity import check, duck
from rewardseg.plans.registry import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_parity(spark, con, name):
    s, o = check(spark, con, name, SF_SMALL)
    assert s == o, f"{name}: spark {s[:2]} vs oracle {o[:2]}"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "pi_entity_fk" and len(df.columns) == 22
    assert df.count() >= 0


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", NAMES)
def test_column_types_match_oracle(spark, con, name):
    spark_types = dict(entry.queries()[name](spark, SF_SMALL).dtypes)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in spark_types.items()} == duck_types
