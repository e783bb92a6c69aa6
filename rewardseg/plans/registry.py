"""Registered queries: name -> (spark, sf_dir) -> DataFrame over the test tables.

Each query derives the sources from the given parquet tables (so its work
grows with them) and runs one operator or step of the segmentation.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from rewardseg import fixed_values as fv
from rewardseg.functions import in_range, matched
from rewardseg.operators import bands, linking, loyalty, products, profile, redemptions
from rewardseg.operators.joins import broadcast_if
from rewardseg.params import TEST_PARAMS, RunParams
from rewardseg.plans.pipeline import SNAPSHOT_COLUMNS, Run, publish_run
from rewardseg.sources import SOURCE_NAMES, Sources, publish, testdata_sources
from rewardseg.sources.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the category_or_scalar query (level-2 arm given explicitly).
L2_EXAMPLE = (3,)
NTILE_N = 5
LINK_MAX_RANK = 1


def make_run(spark: SparkSession, sf_dir: str, params: RunParams = TEST_PARAMS, staging: str = "view") -> Run:
    return Run(testdata_sources(spark, sf_dir, params), params, staging=staging)


def _run(fn: Callable[[Run], DataFrame], staging: str = "view") -> Query:
    """A query computes its own result: every call builds a run of its own."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(make_run(spark, sf_dir, staging=staging))
    query.__doc__ = fn.__doc__
    return query


def _item_lines(r: Run) -> DataFrame:
    return r.items.select("pi_entity_fk", "pi_trans_fk", "pi_product_fk", "line_total")


def _q_date_range(r: Run) -> DataFrame:
    return (r.src["trans_item"].where(in_range("trans_date", r.p.start_date, r.p.end_date))
            .select("pi_trans_fk", "pi_product_fk", "trans_date", "line_total"))


def _q_trans_type(r: Run) -> DataFrame:
    items = r.src["trans_item"]
    types = broadcast_if(r.src["trans_type"].where(F.col("pi_trans_type_desc").isin(*fv.TRANS_TYPES)),
                         r.bounds["trans_type"])
    return (items.join(types, items.pi_trans_type_fk == types.pi_trans_type_pk, "inner")
            .select("pi_trans_fk", "pi_product_fk", "pi_trans_type_desc", "line_total"))


def _q_category_filter(l2: tuple[int, ...]) -> Callable[[Run], DataFrame]:
    def q(r: Run) -> DataFrame:
        cats = products.category_list(r.hierarchy)
        return (products.category_filter(r.hierarchy, cats, l2, r.bounds["web_category_l4"])
                .select("pi_product_pk", "pi_website_category_l3_fk", "pi_website_category_l2_fk"))
    return q


def _q_tender_flag(tender_type: int, name: str) -> Callable[[Run], DataFrame]:
    def q(r: Run) -> DataFrame:
        lines = _item_lines(r)
        hits = loyalty.tender_transactions(r.src["trans_tender"], tender_type)
        hits = hits.withColumn("_hit", F.lit(1))
        return (lines.join(hits, "pi_trans_fk", "left")
                .select(*lines.columns, matched("_hit").alias(name)))
    return q


def _q_online_flag(dedup: bool) -> Callable[[Run], DataFrame]:
    """Line items of each transaction rolled up, with the online flag and
    the spend the (non-distinct or distinct) online join gives them."""
    def q(r: Run) -> DataFrame:
        per_trans = (r.items.groupBy("pi_entity_fk", "pi_trans_fk")
                     .agg(F.sum("line_total").alias("spend")))
        flags = r.flags(dedup).select("pi_trans_fk", "loyalty_online", "multiplicity")
        j = per_trans.join(flags, "pi_trans_fk", "left")
        mult = F.coalesce("multiplicity", F.lit(1)).cast("int")
        return j.select("pi_entity_fk", "pi_trans_fk", F.coalesce("loyalty_online", F.lit(0)).alias("loyalty_online"),
                        (F.col("spend") * mult).cast("decimal(18,2)").alias("spend"))
    return q


def _q_online_loyalty(r: Run) -> DataFrame:
    return loyalty.online_links(r.src, r.p, r.online_orders).select("pi_trans_pk", "order_date",
                                                   F.col("n_links").cast("bigint").alias("n_links"))


def _q_online_rows(r: Run) -> DataFrame:
    return loyalty.online_link_rows(loyalty.online_links(r.src, r.p, r.online_orders))


def _q_ntile(r: Run) -> DataFrame:
    return bands.ntile_bands(bands.spend_long(r.category_spend()), n=NTILE_N,
                             max_groups=len(fv.CATEGORY_NAMES), staging=r.staging)


def _q_ntile_cuts(r: Run) -> DataFrame:
    """The same tiles from their last rows, without sorting the customers."""
    return bands.ntile_by_cuts(bands.spend_long(r.category_spend()), n=NTILE_N, max_groups=len(fv.CATEGORY_NAMES))


def _q_ntile_spenders(r: Run) -> DataFrame:
    """Tiles of positive spend, zero spend as band 1 (an inference)."""
    return bands.positive_ntile_bands(bands.spend_long(r.category_spend()), n=NTILE_N,
                                      max_groups=len(fv.CATEGORY_NAMES), staging=r.staging)


def _q_published(r: Run) -> DataFrame:
    """What ``replace_run`` leaves after two publishes of the same month
    beside an older one: the snapshot once per month."""
    target = f"{r.staging.path}/published"
    rows, older = r.snapshot, r.p.as_of.replace(year=r.p.as_of.year - 1)
    publish(rows.withColumn("update_date", F.lit(older)), target)
    for _ in range(2):
        publish(rows, target, mode="replace_run", run_date=r.p.end_date)
    return r.src_session.read.parquet(target).groupBy("update_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("total_spend").cast("decimal(18,2)").alias("total_spend"))


# Facts are stored by the year of a date; other sources whole.
STORED_BY = {"burn_fact": "tran_date", "trans_item": "trans_date", "trans": "trans_date"}


def store_sources(src: Sources, folder: str, tag: str) -> tuple[dict[str, str], dict[str, dict[str, str]]]:
    """Write every source as a catalog table under ``folder``, with column
    names of the table's own and the facts partitioned by year.  Returns what
    ``Sources.from_tables`` takes: the tables and the column mapping."""
    tables, columns = {}, {}
    for name in SOURCE_NAMES:
        df = src[name]
        columns[name] = {c: f"w_{c}" for c in df.columns}
        tables[name] = f"source_{name}_{tag}"
        rows = df.select(*[F.col(c).alias(columns[name][c]) for c in df.columns])
        by = STORED_BY.get(name)
        if by:
            rows = rows.withColumn("stored_year", F.year(columns[name][by]))
        writer = rows.write.option("path", f"{folder}/{name}")
        (writer.partitionBy("stored_year") if by else writer).saveAsTable(tables[name])
    return tables, columns


def _q_job_over_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly job as deployed: sources in catalog tables with their own
    column names and partitions, read through the column mapping, the run
    published to a catalog table twice (``replace_run``); the published month."""
    staging, tag = Staging(spark), uuid.uuid4().hex
    tables, columns = store_sources(testdata_sources(spark, sf_dir, TEST_PARAMS), f"{staging.path}/sources", tag)
    snapshot, marker = f"snapshot_{tag}", f"marker_{tag}"
    try:
        for _ in range(2):
            rows = publish_run(Sources.from_tables(spark, tables, columns), TEST_PARAMS, snapshot, marker, mode="replace_run")
        return staging.write(rows.select(*SNAPSHOT_COLUMNS), "published")
    finally:
        for table in (*tables.values(), snapshot, marker):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def _q_segments_rolling(r: Run) -> DataFrame:
    p = replace(r.p, activity="rolling_12m")
    return redemptions.segments(redemptions.redemption_groups(r.summary, p))


def _q_value_score(r: Run) -> DataFrame:
    return profile.value_score_month(r.src["value_score"], r.p)


QUERIES: dict[str, Query] = {
    # Part I
    "run_bounds": _run(lambda r: redemptions.run_bounds(r.src["date_dim"], r.p)),
    "week_marker": _run(lambda r: r.week_marker),
    "redemptions": _run(lambda r: r.redemptions),
    "redemption_summary": _run(lambda r: r.summary),
    "redemption_groups": _run(lambda r: r.groups),
    "segments": _run(lambda r: r.segments),
    "segment_counts": _run(lambda r: redemptions.segment_counts(r.segments)),
    "segments_rolling_year": _run(_q_segments_rolling),
    "profile_base": _run(lambda r: r.profile_base),
    "profile_counts": _run(lambda r: redemptions.profile_counts(r.profile_base)),
    # Part II -- products and line items
    "product_hierarchy": _run(lambda r: r.hierarchy),
    "category_list": _run(lambda r: products.category_list(r.hierarchy)),
    "category_in_filter": _run(_q_category_filter(())),
    "category_or_scalar": _run(_q_category_filter(L2_EXAMPLE)),
    "date_range_filter": _run(_q_date_range),
    "trans_type_filter": _run(_q_trans_type),
    "item_base": _run(lambda r: r.items.select(*products.ITEM_COLUMNS)),
    # Part II -- loyalty flags
    "flag_loyalty_instore": _run(_q_tender_flag(fv.TENDER_LOYALTY_INSTORE, "loyalty_instore")),
    "flag_redeemed_instore": _run(_q_tender_flag(fv.TENDER_REDEMPTION_INSTORE, "instore_red")),
    "reservation_left_join": _run(lambda r: loyalty.reservation_left_join(r.src, r.p)),
    "delivery_left_join": _run(lambda r: loyalty.delivery_left_join(r.src, r.p)),
    "coalesce_key_join": _run(lambda r: loyalty.online_orders(r.src, r.p)),
    "online_loyalty": _run(_q_online_loyalty, "shared"),
    "online_loyalty_rows": _run(_q_online_rows, "shared"),
    "flag_loyalty_online": _run(_q_online_flag(dedup=False), "shared"),
    "flag_loyalty_online_dedup": _run(_q_online_flag(dedup=True), "shared"),
    # Part II -- spend
    "entity_spend": _run(lambda r: r.entity_spend(), "shared"),
    "entity_spend_dedup": _run(lambda r: r.entity_spend(dedup=True), "shared"),
    "eligible_customers": _run(lambda r: r.eligible, "shared"),
    "category_spend": _run(lambda r: r.category_spend(), "shared"),
    "category_spend_dedup": _run(lambda r: r.category_spend(dedup=True), "shared"),
    "value_score_month": _run(_q_value_score),
    "spend_bands": _run(lambda r: profile.spend_bands(r.category_spend()), "shared"),
    "band_technology_fixed": _run(lambda r: profile.technology_band_fixed(r.category_spend()), "shared"),
    "retail_profile": _run(lambda r: r.retail_profile, "shared"),
    "profile_duplicates": _run(lambda r: profile.profile_duplicates(r.retail_profile), "shared"),
    "ntile_bands": _run(_q_ntile, "parquet"),
    "ntile_bands_by_cuts": _run(_q_ntile_cuts, "parquet"),
    "ntile_bands_spenders": _run(_q_ntile_spenders, "parquet"),
    # Part III -- linking and snapshot
    "link_loyalty": _run(lambda r: r.link_loyalty, "shared"),
    "link_account": _run(lambda r: r.link_account, "shared"),
    "link_cardinality": _run(lambda r: linking.link_cardinality(r.link_account), "shared"),
    "link_rank": _run(lambda r: linking.rank_through_cards(r.profiled, r.entity_cards, r.src["full_card"], LINK_MAX_RANK), "shared"),
    "account_collapse": _run(lambda r: linking.account_collapse(r.link_account), "shared"),
    "link_share": _run(lambda r: linking.link_share(r.link_account), "shared"),
    "snapshot": _run(lambda r: r.snapshot, "parquet"),
    "published_months": _run(_q_published, "parquet"),
    "job_over_tables": _q_job_over_tables,
}
