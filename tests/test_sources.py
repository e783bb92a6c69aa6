"""Source contracts: conform (prune, cast, reject), catalog-backed sources."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from conftest import SF_SMALL
from rewardseg.params import TEST_PARAMS
from rewardseg.plans.pipeline import Run
from rewardseg.sources import SOURCE_NAMES, Sources, conform
from rewardseg.sources import testdata_sources as derive_sources
from rewardseg.sources.contracts import ContractError


def test_conform_prunes_casts_and_matches_case(spark):
    df = spark.createDataFrame(
        [(1, 10, dt.datetime(2000, 12, 31, 23, 59), "RETAIL", "RC", "DL", "extra")],
        "ACCOUNT_NUMBER int, TRAN_POINTS int, TRAN_DATE timestamp_ntz, SUPPLIER_ID string, "
        "REDEMPTION_STATUS string, REASON_CODE string, unused string")
    out = conform(df, "burn_fact")
    assert out.columns == ["account_number", "tran_points", "tran_date", "supplier_id",
                           "redemption_status", "reason_code"]
    assert dict(out.dtypes)["account_number"] == "bigint"
    # a timestamp late on the last day stays inside an inclusive date range
    assert out.first()["tran_date"] == dt.date(2000, 12, 31)


def test_conform_rejects_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "account_number long")
    with pytest.raises(ContractError):
        conform(df, "burn_fact")


def test_sources_from_catalog_tables(spark):
    derived = derive_sources(spark, SF_SMALL, TEST_PARAMS)
    for name in SOURCE_NAMES:
        derived[name].createOrReplaceTempView(f"src_{name}")
    src = Sources.from_tables(spark, {name: f"src_{name}" for name in SOURCE_NAMES})
    got = Run(src, TEST_PARAMS, staging="view").segments
    ref = Run(derived, TEST_PARAMS, staging="view").segments
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_unknown_source_name_is_rejected():
    with pytest.raises(KeyError):
        Sources({"not_a_source": lambda: None})


def test_own_column_names_are_mapped(spark):
    df = spark.createDataFrame([(7, dt.date(2000, 1, 2), 200001, 1, -1)],
                               "junk int, day date, period int, week int, relative_js_week_num int")
    names = {"date_key": "DAY", "fin_period_no": "period", "week_no": "week", "relative_week": "relative_js_week_num"}
    src = Sources({"date_dim": lambda: df}, {"date_dim": names})
    assert [tuple(r) for r in src["date_dim"].collect()] == [(dt.date(2000, 1, 2), 200001, 1, -1)]
    with pytest.raises(ContractError):
        conform(df, "date_dim", {**names, "no_such": "day"})


@pytest.mark.parametrize("kind,value", [("decimal(14,4)", Decimal("1.0051")), ("double", 1.5)])
def test_narrowing_casts_are_refused(spark, kind, value):
    df = spark.createDataFrame([(1, 1, 1, dt.date(2000, 1, 1), 1, 1, value)],
                               "pi_entity_fk long, pi_trans_fk long, pi_product_fk long, trans_date date, pi_channel_fk int, "
                               f"pi_trans_type_fk int, line_total {kind}")
    with pytest.raises(ContractError):
        conform(df, "trans_item")
    score = spark.createDataFrame([(1, 3.7, dt.date(2000, 1, 1))], "entitykey long, current_value_score double, run_date date")
    with pytest.raises(ContractError):
        conform(score, "value_score")


def test_job_publishes_from_a_source_mapping(spark, tmp_path):
    from rewardseg.job import main
    derived = derive_sources(spark, SF_SMALL, TEST_PARAMS)
    for name in SOURCE_NAMES:
        derived[name].write.parquet(f"{tmp_path}/in/{name}")
    config = tmp_path / "sources.json"
    config.write_text(json.dumps({"root": f"{tmp_path}/in"}))
    args = ["--as-of", "2000-12-31", "--start-year", "1996", "--sources", str(config), "--snapshot", f"{tmp_path}/out",
            "--marker", f"{tmp_path}/marker", "--mode", "replace_run"]
    rows = main(args)
    assert rows == main(args) == spark.read.parquet(f"{tmp_path}/out").count() > 0
