"""Part I: redemption facts -> one behavioural segment per loyalty account."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from rewardseg import fixed_values as fv
from rewardseg.functions import (any_flag, in_range, season_label, segment_label, size_label,
                                 volume_label)
from rewardseg.params import RunParams
from rewardseg.sources import Sources


def week_marker(date_dim: DataFrame) -> DataFrame:
    """Last calendar date of each (period, week) of the previous week."""
    return (date_dim.where(F.col("relative_week") == -1)
            .groupBy("fin_period_no", "week_no")
            .agg(F.max("date_key").alias("update_date")))


def run_bounds(date_dim: DataFrame, p: RunParams) -> DataFrame:
    """One row: first calendar date of ``start_year`` and the run date.  The
    year test is written as a date range so it reaches the scan."""
    year_first, year_last = dt.date(p.start_year, 1, 1), dt.date(p.start_year, 12, 31)
    return (date_dim.where(in_range("date_key", year_first, year_last))
            .agg(F.min("date_key").alias("start_date"))
            .select("start_date", F.lit(p.end_date).alias("end_date")))


def resolve_params(src: Sources, p: RunParams) -> RunParams:
    """Fix the window start once per run (a one-row aggregate), so every
    date filter downstream is a literal that reaches the parquet scan."""
    if p.start_date is not None:
        return p
    row = run_bounds(src["date_dim"], p).first()
    if row is None or row["start_date"] is None:
        raise ValueError(f"date dimension has no date in {p.start_year}")
    return p.with_start(row["start_date"])


def redemptions(burn: DataFrame, p: RunParams) -> DataFrame:
    """Supplier redemptions with positive points inside the run window."""
    return (burn.where((F.col("supplier_id") == p.supplier_code)
                       & (F.col("tran_points") > 0)
                       & (F.col("redemption_status") == fv.REDEMPTION_STATUS)
                       & (F.col("reason_code") == fv.REASON_CODE)
                       & in_range("tran_date", p.start_date, p.end_date))
            .select("account_number", "tran_points", F.to_date("tran_date").alias("tran_date")))


def redemption_summary(red: DataFrame) -> DataFrame:
    """Per account: count, total, largest, November/December flags, latest date.

    Partial (map-side) aggregation collapses a hot account inside each task
    before the shuffle, so one account holding a third of the facts costs
    one row per map task, not a third of the data in one reducer.
    """
    month = F.month("tran_date")
    return red.groupBy("account_number").agg(
        F.count(F.lit(1)).alias("reds"),
        F.sum("tran_points").alias("points_red"),
        F.max("tran_points").alias("largest_red"),
        any_flag(month == fv.NOVEMBER).alias("nov_reder"),
        any_flag(month == fv.DECEMBER).alias("xmas_reder"),
        F.max("tran_date").alias("most_recent_red"))


def active_this_year(latest: str, p: RunParams):
    """1 when the latest redemption counts as this year's, else 0."""
    if p.activity == "calendar_year":
        cond = F.year(latest) == p.end_date.year
    elif p.activity == "rolling_12m":
        cond = F.col(latest) > F.add_months(F.lit(p.end_date), -12)
    else:
        raise ValueError(f"unknown activity rule {p.activity!r}")
    return F.when(cond, 1).otherwise(0)


def redemption_groups(summary: DataFrame, p: RunParams) -> DataFrame:
    """Season, size and volume labels; active this year (calendar year of
    the run date by default, see ``RunParams.activity``)."""
    return summary.select(
        season_label("nov_reder", "xmas_reder").alias("xmas_bf_reder"),
        size_label("largest_red").alias("red_size"),
        volume_label("reds").alias("red_vol"),
        active_this_year("most_recent_red", p).alias("red_this_year"),
        "points_red", "reds", "account_number")


def segments(groups: DataFrame) -> DataFrame:
    return groups.select(
        "account_number",
        segment_label("red_this_year", "xmas_bf_reder", "red_size", "red_vol").alias("segment"))


def profile_base(seg: DataFrame, profile: DataFrame) -> DataFrame:
    """Segment x demographics (inner on account), distinct rows."""
    demo = profile.select("account_number", "age_band", "gender", "region", "acorn_category")
    return (seg.join(demo, "account_number", "inner")
            .select("account_number", "segment", "age_band", "gender", "region", "acorn_category")
            .distinct())


PROFILE_DIMENSIONS = ("age_band", "gender", "region", "acorn_category")


def profile_counts(base: DataFrame, dims=PROFILE_DIMENSIONS) -> DataFrame:
    """Accounts per (segment, dimension, value) in one aggregation: the
    dimensions are unpivoted with ``stack`` so the data shuffles once."""
    pairs = ", ".join(f"'{d}', cast(`{d}` as string)" for d in dims)
    long = base.selectExpr("segment", f"stack({len(dims)}, {pairs}) as (dimension, value)")
    return long.groupBy("segment", "dimension", "value").agg(F.count(F.lit(1)).alias("accounts"))


def segment_counts(seg: DataFrame) -> DataFrame:
    return seg.groupBy("segment").agg(F.count(F.lit(1)).alias("accounts"))
