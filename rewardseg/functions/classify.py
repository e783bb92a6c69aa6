"""Classification expressions: label ladders, spend bands, recodes.

All are chained ``CASE WHEN`` expressions built from the tables in
``rewardseg.fixed_values`` -- JVM-side, inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

from rewardseg import fixed_values as fv
from rewardseg.functions.predicates import col


def descending_label(value: str | Column, ladder: Sequence[tuple[object, str]], other: str) -> Column:
    """First ``(threshold, label)`` with ``value > threshold`` wins, else ``other``."""
    value = col(value)
    out = None
    for threshold, label in ladder:
        cond = value > F.lit(threshold)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(other)


def spend_band(value: str | Column, cut_points: Sequence[Decimal]) -> Column:
    """Band of a spend amount.

    ``0 -> 1``; ``(cut[i-1], cut[i]] -> i + 2`` with ``cut[-1] = 0``;
    ``> cut[-1] -> len(cuts) + 2``; negative or NULL -> NULL (no ELSE).
    Intervals are taken in the listed order, first match wins, so a cut list
    that is not ascending reproduces the empty interval as written.
    Left-open/right-closed, unlike ``Bucketizer``.
    """
    v = col(value)
    out = F.when(v == 0, 1)
    lower = Decimal(0)
    for i, upper in enumerate(cut_points):
        out = out.when((v > F.lit(lower)) & (v <= F.lit(upper)), i + 2)
        lower = upper
    return out.when(v > F.lit(cut_points[-1]), len(cut_points) + 2)


def category_band(category: str, value: str | Column | None = None) -> Column:
    value = value if value is not None else f"{category}_spend"
    return spend_band(value, fv.cuts(category)).alias(f"{category}_spend_band")


def all_bands() -> list[Column]:
    return [category_band(name) for name in fv.CATEGORY_NAMES]


def gender_code(gender: str | Column) -> Column:
    """F -> 1, M -> 2, anything else (NULL and unmatched included) -> 3."""
    g = col(gender)
    out = None
    for label, code in fv.GENDER_CODES:
        out = F.when(g == label, code) if out is None else out.when(g == label, code)
    return out.otherwise(fv.GENDER_OTHER)


def category_index(l1_desc: str | Column) -> Column:
    """Position of the spend category of a level-1 description (NULL: none).
    Exact, case-sensitive match; two descriptions share one category."""
    l1 = col(l1_desc)
    out = None
    for i, (_, labels) in enumerate(fv.CATEGORIES):
        cond = l1.isin(*labels)
        out = F.when(cond, i) if out is None else out.when(cond, i)
    return out


def season_label(nov: str | Column, xmas: str | Column) -> Column:
    return F.when(col(nov) + col(xmas) == 0, fv.SEASON_NONE).otherwise(fv.SEASON_ANY)


def size_label(largest: str | Column) -> Column:
    return descending_label(largest, fv.SIZE_LADDER, fv.SIZE_OTHER)


def volume_label(count: str | Column) -> Column:
    return descending_label(count, fv.VOLUME_LADDER, fv.VOLUME_OTHER)


def segment_label(this_year: str | Column, season: str | Column, size: str | Column,
                  volume: str | Column) -> Column:
    """First match wins: inactive this year, large seasonal, large, size_volume."""
    size = col(size)
    return (F.when(col(this_year) == 0, fv.SEGMENT_INFREQUENT)
            .when((col(season) == fv.SEASON_ANY) & (size == fv.SEGMENT_LARGE), fv.SEGMENT_LARGE_SEASONAL)
            .when(size == fv.SEGMENT_LARGE, fv.SEGMENT_LARGE)
            .otherwise(F.concat(size, F.lit(fv.SEGMENT_SEPARATOR), col(volume))))
