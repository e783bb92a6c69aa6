"""Predicates and small column helpers shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_range(c: str | Column, start: dt.date, end: dt.date) -> Column:
    """Inclusive date range with literal bounds (pushed to the scan)."""
    return col(c).between(F.lit(start), F.lit(end))


def ne_or_null(c: str | Column, value) -> Column:
    """``c <> value OR c IS NULL`` -- keeps NULLs that ``<>`` alone drops."""
    c = col(c)
    return (c != F.lit(value)) | c.isNull()


def valid_on(unlink: str | Column, day: str | Column) -> Column:
    """Open-ended validity: not unlinked before ``day`` (NULL = still linked)."""
    unlink = col(unlink)
    return (unlink >= col(day)) | unlink.isNull()


def matched(c: str | Column) -> Column:
    """1 when an outer-join partner exists, else 0."""
    return F.when(col(c).isNotNull(), 1).otherwise(0)


def any_flag(cond: Column) -> Column:
    """Aggregate: 1 when any row of the group satisfies ``cond``."""
    return F.max(F.when(cond, 1).otherwise(0))


def month_of(c: str | Column, first: dt.date, last: dt.date) -> Column:
    """Sargable form of ``year(c) = y AND month(c) = m`` for a date column."""
    return col(c).between(F.lit(first), F.lit(last))
