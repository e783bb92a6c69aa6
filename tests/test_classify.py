"""Boundary tables for every label ladder and spend band."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from rewardseg import fixed_values as fv
from rewardseg.functions import (category_index, gender_code, segment_label, size_label,
                                 spend_band, volume_label)


def _eval(spark, values, expr_fn, dtype):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


def expected_band(v, cuts):
    """Band rule written independently: first matching interval wins."""
    if v is None:
        return None
    if v == 0:
        return 1
    lower = Decimal(0)
    for i, c in enumerate(cuts):
        if lower < v <= c:
            return i + 2
        lower = c
    if v > cuts[-1]:
        return len(cuts) + 2
    return None


@pytest.mark.parametrize("category", fv.CATEGORY_NAMES)
def test_band_boundaries(spark, category):
    cuts = fv.cuts(category)
    cent = Decimal("0.01")
    values = [None, Decimal("0"), Decimal("-0.01"), cent]
    for c in cuts:
        values += [c - cent, c, c + cent]
    values.append(max(cuts) * 10)
    got = _eval(spark, values, lambda c: spend_band(c, cuts), T.DecimalType(18, 2))
    assert got == [expected_band(v, cuts) for v in values]


def test_technology_band_five_is_unreachable(spark):
    values = [Decimal(x) for x in ("68.01", "135", "135.01", "174", "174.01", "500")]
    got = _eval(spark, values, lambda c: spend_band(c, fv.cuts("technology")), T.DecimalType(18, 2))
    assert got == [4, 4, 4, 4, 6, 6]
    fixed = tuple(Decimal(c) for c in fv.TECHNOLOGY_CUTS_FIXED)
    got_fixed = _eval(spark, values, lambda c: spend_band(c, fixed), T.DecimalType(18, 2))
    assert got_fixed == [4, 4, 5, 5, 6, 6]


def test_size_ladder(spark):
    got = _eval(spark, [2000, 2001, 5000, 5001, 1], size_label, T.LongType())
    assert got == ["SMALL_RED", "MID_RED", "MID_RED", "LARGE_RED", "SMALL_RED"]


def test_volume_ladder(spark):
    got = _eval(spark, [1, 2, 4, 5, 10, 11], volume_label, T.LongType())
    assert got == ["SINGLE", "LOW", "LOW", "MID", "MID", "HIGH"]


def test_segment_first_match_wins(spark):
    rows = [(0, "XMAS_BF", "LARGE_RED", "HIGH"), (1, "XMAS_BF", "LARGE_RED", "HIGH"),
            (1, "NO_XMAS_BF", "LARGE_RED", "LOW"), (1, "XMAS_BF", "MID_RED", "SINGLE"),
            (1, "NO_XMAS_BF", "SMALL_RED", "MID")]
    df = spark.createDataFrame(rows, "y int, s string, size string, vol string")
    got = [r[0] for r in df.select(segment_label("y", "s", "size", "vol")).collect()]
    assert got == ["INFREQUENT", "L_X_BF", "LARGE_RED", "MID_RED_SINGLE", "SMALL_RED_MID"]


def test_gender_recode_else_takes_null(spark):
    got = _eval(spark, ["F", "M", "U", None, "f"], gender_code, T.StringType())
    assert got == [1, 2, 3, 3, 3]


def test_category_index_exact_match(spark):
    got = _eval(spark, ["Baby and Nursery", "Garden and DIY", "Home and garden", "Gifts", "gifts", None],
                category_index, T.StringType())
    assert got == [0, 3, 3, 10, None, None]
