"""Run parameters: the run date and history start replace session variables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from rewardseg.fixed_values import ONLINE_LINK_GRACE_DAYS


@dataclass(frozen=True)
class RunParams:
    """Parameters of one monthly run.

    ``as_of`` is the run date (end of the history window, inclusive) and the
    snapshot's ``update_date``.  The window starts at the first calendar date
    of ``start_year`` present in the date dimension; pass ``start_date`` to
    skip that lookup.  ``supplier_code`` is the supplier whose redemptions
    are segmented.
    """

    as_of: dt.date
    start_year: int
    start_date: dt.date | None = None
    grace_days: int = ONLINE_LINK_GRACE_DAYS
    supplier_code: str = "RETAIL"
    l2_categories: tuple[int, ...] = ()
    # "calendar_year": latest redemption in the run's calendar year (as the
    # SQL does); "rolling_12m": within the 12 months before the run date
    # (the prose reading "redeemed within the past year").
    activity: str = "calendar_year"

    @property
    def end_date(self) -> dt.date:
        return self.as_of

    def with_start(self, start: dt.date) -> "RunParams":
        return replace(self, start_date=start)

    @property
    def month_first(self) -> dt.date:
        return self.as_of.replace(day=1)

    @property
    def month_last(self) -> dt.date:
        nxt = (self.as_of.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return nxt - dt.timedelta(days=1)

    @property
    def week_start(self) -> dt.date:
        """Monday of the week holding ``as_of``."""
        return self.as_of - dt.timedelta(days=self.as_of.weekday())


# Parameters of the test fixtures (FIXTURES.md).
TEST_PARAMS = RunParams(as_of=dt.date(2000, 12, 31), start_year=1996)
