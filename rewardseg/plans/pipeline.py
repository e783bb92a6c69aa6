"""The whole monthly run as Spark plans.

``Run`` builds every step lazily from the sources, sharing sub-plans instead
of re-deriving them (the line-item star is defined once and read by both
spend steps).  ``run_segmentation`` returns the snapshot; ``publish_run``
writes the week marker and appends the snapshot.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from rewardseg import fixed_values as fv
from rewardseg.operators import linking, loyalty, products, profile, redemptions, spend
from rewardseg.operators.joins import hot_keys, join_splitting
from rewardseg.params import RunParams
from rewardseg.sources import Sources, publish, write_marker
from rewardseg.sources.sinks import read_run
from rewardseg.sources.staging import Staging

SNAPSHOT_COLUMNS = (
    "pi_entity_fk", "account_number", "segment", "age_band", "gender", "region",
    "acorn_category", "current_value_score", *fv.BAND_COLUMNS, "total_spend",
    "points_balance", "update_date",
)


class Run:
    """Lazily built steps of one run.  ``staging="parquet"`` writes what
    several later steps read (online orders, entity-grain category spend, the
    account side of the snapshot) to the run's folder on shared storage, so
    that it is made once and a lost executor does not send the run back to
    the fact scan; ``close()`` removes the folder.  ``staging="shared"``
    writes only what one step reads twice, the online orders (for the days
    that the link sweep is asked about, and to join its answers): a query of
    one spend step then evaluates their three joins once."""

    def __init__(self, src: Sources, params: RunParams, staging: str = "view", bucketed: bool = False):
        if staging not in ("view", "shared", "parquet"):
            raise ValueError(f"unknown staging {staging!r}")
        self.src = src
        self.p = redemptions.resolve_params(src, params)
        self.src_session = src["date_dim"].sparkSession
        self.staging = Staging(self.src_session)
        self._staged = staging == "parquet"
        self._shared = staging != "view"
        self._bucketed = bucketed

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return self.staging.write(df, name) if self._staged else df

    def close(self) -> None:
        self.staging.remove()

    # Part I -- account grain
    @cached_property
    def redemptions(self) -> DataFrame:
        return redemptions.redemptions(self.src["burn_fact"], self.p)

    @cached_property
    def summary(self) -> DataFrame:
        return redemptions.redemption_summary(self.redemptions)

    @cached_property
    def groups(self) -> DataFrame:
        return redemptions.redemption_groups(self.summary, self.p)

    @cached_property
    def segments(self) -> DataFrame:
        return redemptions.segments(self.groups)

    @cached_property
    def profile_base(self) -> DataFrame:
        return redemptions.profile_base(self.segments, self.src["data_profile"])

    @cached_property
    def week_marker(self) -> DataFrame:
        return redemptions.week_marker(self.src["date_dim"])

    # Part II -- entity grain
    @cached_property
    def bounds(self) -> dict[str, bool]:
        """Row-bound checks of all star dimensions (one job per run)."""
        return products.star_bounds(self.src, self.p)

    @cached_property
    def hierarchy(self) -> DataFrame:
        return products.product_hierarchy(self.src, self.bounds)

    @cached_property
    def items(self) -> DataFrame:
        return products.item_base(self.src, self.p, self.hierarchy, self.bounds)

    @cached_property
    def online_orders(self) -> DataFrame:
        orders = loyalty.online_orders(self.src, self.p)
        return self.staging.write(orders, "online-orders") if self._shared else orders

    def flags(self, dedup: bool = False) -> DataFrame:
        return loyalty.transaction_flags(self.src, self.p, dedup_online=dedup, orders=self.online_orders)

    def lines(self, dedup: bool = False) -> DataFrame:
        """Line items with their transaction flags (the one spend stream)."""
        if self._bucketed:
            return spend.flagged_bucketed_lines(self.items, loyalty.tender_flags(self.src),
                                                loyalty.online_flags(self.src, self.p, dedup, self.online_orders))
        return spend.flagged_lines(self.items, self.flags(dedup))

    def entity_spend(self, dedup: bool = False) -> DataFrame:
        return spend.entity_spend(self.lines(dedup))

    @cached_property
    def eligible(self) -> DataFrame:
        return spend.eligible_customers(self.entity_spend())

    @cached_property
    def _category_spend(self) -> DataFrame:
        return self._stage(spend.category_spend(self.lines(), self.p), "category-spend")

    def category_spend(self, dedup: bool = False) -> DataFrame:
        """Read by the profile, bands, links and snapshot: staged once."""
        if dedup:
            return spend.category_spend(self.lines(), self.p, dedup=True)
        return self._category_spend

    @cached_property
    def retail_profile(self) -> DataFrame:
        return profile.retail_profile(self.category_spend(), self.src["customer_profiling"],
                                      self.src["value_score"], self.p)

    @cached_property
    def profiled(self) -> DataFrame:
        """Profile rows the linking steps read: no gender, with total spend."""
        return profile.retail_profile(self.category_spend(), None, self.src["value_score"], self.p,
                                      keep_total=True)

    # Part III -- linking
    @cached_property
    def entity_cards(self) -> DataFrame:
        return linking.entity_cards(self.src)

    @cached_property
    def link_loyalty(self) -> DataFrame:
        return linking.link_loyalty(self.profiled, self.entity_cards)

    @cached_property
    def link_account(self) -> DataFrame:
        accounts = linking.entity_accounts(self.entity_cards, self.src["full_card"])
        return linking.link_account(self.profiled, accounts)

    @cached_property
    def account_side(self) -> DataFrame:
        return self._stage(account_side(self.segments, self.src["data_profile"], self._stage), "accounts")

    @cached_property
    def snapshot(self) -> DataFrame:
        return snapshot(self.account_side, self.link_account, self.p)


def account_side(segments: DataFrame, data_profile: DataFrame, stage=None) -> DataFrame:
    """Per account: segment, every distinct demographics row and points
    balance (all their pairs, as joining the profile twice gives).

    The profile is read once, to its distinct rows, which ``stage(df, name)``
    may keep; both sides come from these.  An account with a large share of
    them is split in both joins of the chain."""
    demographic = ("age_band", "gender", "region", "acorn_category")
    rows = data_profile.select("account_number", *demographic, F.col("total_points").alias("points_balance")).distinct()
    rows = stage(rows, "profiles") if stage else rows
    hot = hot_keys(rows, "account_number")
    hot = stage(hot, "hot-accounts") if stage else hot
    demographics = rows.select("account_number", *demographic).distinct()
    points = rows.select("account_number", "points_balance").distinct()
    owned = join_splitting(segments.select("account_number", "segment"), demographics, "account_number", hot)
    return join_splitting(owned, points, "account_number", hot).select(
        "account_number", "segment", *demographic, "points_balance")


def snapshot(accounts: DataFrame, linked: DataFrame, p: RunParams) -> DataFrame:
    """The account side x the linked retail profile, stamped with the run
    date: one join on the account, whose hot keys adaptive execution splits
    when both sides are shuffled for it (the account side is staged).

    Both sides are distinct, so the joined rows are distinct and the DISTINCT
    of the rules costs no extra shuffle.
    """
    spent = linked.where(F.col("total_spend") > 0)
    return accounts.join(spent, "account_number", "inner").select(
        "pi_entity_fk", "account_number", "segment", "age_band", "gender", "region",
        "acorn_category", "current_value_score", *fv.BAND_COLUMNS, "total_spend",
        "points_balance", F.lit(p.end_date).alias("update_date"))


def run_segmentation(src: Sources, params: RunParams, staging: str = "view") -> DataFrame:
    return Run(src, params, staging=staging).snapshot


def publish_run(src: Sources, params: RunParams, snapshot_target: str, marker_target: str,
                mode: str = "append", staging: str = "parquet") -> DataFrame:
    """The scheduled job: overwrite the week marker, publish the snapshot,
    remove what was staged.  Returns the published rows of this run."""
    run = Run(src, params, staging=staging)
    try:
        write_marker(run.week_marker, marker_target)
        publish(run.snapshot, snapshot_target, mode=mode, run_date=run.p.end_date)
    finally:
        run.close()
    return read_run(run.src_session, snapshot_target, run.p.end_date)
