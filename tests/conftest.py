import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rewardseg.session import build_session
    session = build_session("local[*]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def run_check(spark):
    """The run over the sf0.01 tables (FIXTURES.md goldens)."""
    from rewardseg.plans.registry import make_run
    run = make_run(spark, SF_CHECK, staging="parquet")
    yield run
    run.close()
