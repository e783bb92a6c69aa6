"""Product hierarchy, category list and the filtered line-item base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rewardseg import fixed_values as fv
from rewardseg.functions import category_index, in_range, ne_or_null
from rewardseg.operators.joins import DIM_BROADCAST_BYTES, bounded_sizes, broadcast_if, key_stats
from rewardseg.params import RunParams
from rewardseg.sources import Sources

HIERARCHY_COLUMNS = (
    "pi_product_pk", "is_live", "short_desc",
    "pi_website_category_l4_pk", "pi_website_category_l4_desc",
    "pi_website_category_l3_fk", "pi_website_category_l3_desc",
    "pi_website_category_l2_fk", "pi_website_category_l2_desc",
    "pi_website_category_l1_fk", "pi_website_category_l1_desc",
    "pi_buying_category_fk", "pi_buying_category_desc", "website_category_url",
)


ITEM_COLUMNS = ("pi_entity_fk", "pi_trans_fk", "pi_product_fk", "trans_date", "line_total",
                "pi_website_category_l1_desc", "pi_website_category_l3_fk")

Bounds = dict[str, bool]


def star_dimensions(src: Sources, p: RunParams) -> dict[str, DataFrame]:
    """Dimension sides of the product hierarchy and the line-item star."""
    return {
        "range_subsection": src["range_subsection"],
        "web_category_l4": src["web_category_l4"],
        "date_dim": src["date_dim"].select("date_key").where(in_range("date_key", p.start_date, p.end_date)),
        "channel": src["channel"],
        "trans_type": (src["trans_type"].where(F.col("pi_trans_type_desc").isin(*fv.TRANS_TYPES))
                       .select("pi_trans_type_pk")),
    }


STAR_KEYS = {
    "range_subsection": "pi_range_subsection_pk",
    "web_category_l4": "pi_website_category_l4_pk",
    "product": "pi_product_pk",
    "date_dim": "date_key",
    "channel": "pi_channel_pk",
    "trans_type": "pi_trans_type_pk",
}


def star_bounds(src: Sources, p: RunParams) -> Bounds:
    """Row-bound checks of every broadcast candidate of the star.

    One job sums the rows, distinct keys and bytes of every dimension.  When the
    product, subsection and category keys are unique, each product yields
    at most one gate row (every join of the gate is on one of those keys),
    so the gate's bound follows from the product count; otherwise the gate
    itself is counted in a second job.
    """
    sides = dict(star_dimensions(src, p), product=src["product"])
    stats = key_stats({name: (df, STAR_KEYS[name]) for name, df in sides.items()})
    bounds = {name: size <= DIM_BROADCAST_BYTES for name, (_, _, size) in stats.items()}
    unique = {name: n == keys for name, (n, keys, _) in stats.items()}
    bounds["unique_keys"] = all(unique[n] for n in ("product", "range_subsection", "web_category_l4"))
    if bounds["product"] and all(unique[n] for n in ("product", "range_subsection", "web_category_l4")):
        bounds["product_gate"] = True
    else:
        gate = product_gate(src, product_hierarchy(src, bounds), p, bounds)
        bounds.update(bounded_sizes({"product_gate": gate}))
    return bounds


def product_hierarchy(src: Sources, bounds: Bounds | None = None) -> DataFrame:
    """Product -> (left) subsection -> (inner) website category l4,
    dropping the excluded series but keeping products whose series is NULL
    (unmatched subsection included, since the outer join yields NULL)."""
    if bounds is None:
        bounds = bounded_sizes({"range_subsection": src["range_subsection"],
                                "web_category_l4": src["web_category_l4"]})
    product = src["product"]
    subsection = broadcast_if(src["range_subsection"], bounds.get("range_subsection", False))
    l4 = broadcast_if(src["web_category_l4"], bounds.get("web_category_l4", False))
    return (product
            .join(subsection, product.pi_range_subsection_fk == subsection.pi_range_subsection_pk, "left")
            .join(l4, product.pi_website_category_l4_fk == l4.pi_website_category_l4_pk, "inner")
            .where(ne_or_null(subsection.pi_range_series_fk, fv.EXCLUDED_RANGE_SERIES))
            .select(*HIERARCHY_COLUMNS))


def category_list(hierarchy: DataFrame) -> DataFrame:
    """Distinct level-3 categories; the level-2 column is the constant 0."""
    return (hierarchy.select(F.col("pi_website_category_l3_fk").alias("l3_category")).distinct()
            .select("l3_category", F.lit(0).alias("l2_category")))


def category_filter(df: DataFrame, cats: DataFrame, l2_categories: Sequence[int] = (),
                    cats_bounded: bool = False) -> DataFrame:
    """Rows whose level-3 category is a positive entry of ``cats``, or whose
    level-2 category is in ``l2_categories``.

    The level-2 arm compares to a subquery over a column that is always 0,
    which yields NULL and never matches; it is kept as an explicit list,
    empty by default, in which case the filter is a plain semi join.  The
    category list is a distinct projection of the category table, so it is
    broadcast when that table passed its row bound (``cats_bounded``).
    """
    l3 = broadcast_if(cats.where(F.col("l3_category") > 0).select("l3_category").distinct(), cats_bounded)
    key = F.col("pi_website_category_l3_fk")
    if not l2_categories:
        return df.join(l3, key == l3.l3_category, "left_semi")
    marked = df.join(l3.withColumn("_l3_hit", F.lit(True)), key == l3.l3_category, "left")
    return (marked.where(F.col("_l3_hit").isNotNull()
                         | F.col("pi_website_category_l2_fk").isin(*l2_categories))
            .drop("l3_category", "_l3_hit"))


def product_gate(src: Sources, hierarchy: DataFrame, p: RunParams, bounds: Bounds) -> DataFrame:
    """Dimension side of the line-item star, resolved once at product grain.

    Hierarchy rows joined again to the product (inner on its key) and to the
    subsection through the product's own subsection key (inner: a
    product with no subsection row drops here although the hierarchy kept
    it), then the category filter.  Every predicate of the star that only
    touches dimension columns is applied here, before the fact join.
    """
    if bounds.get("unique_keys"):
        # the joins below meet each product's own rows again, and the category list holds every level-3
        # key of the hierarchy: one pass over the product side, with the subsection join made inner
        keep = F.col("pi_website_category_l3_fk") > 0
        if p.l2_categories:
            keep = keep | F.col("pi_website_category_l2_fk").isin(*p.l2_categories)
        subsection = broadcast_if(src["range_subsection"], bounds.get("range_subsection", False))
        l4 = broadcast_if(src["web_category_l4"], bounds.get("web_category_l4", False))
        once = (src["product"].join(subsection, F.col("pi_range_subsection_fk") == F.col("pi_range_subsection_pk"))
                .where(ne_or_null(F.col("pi_range_series_fk"), fv.EXCLUDED_RANGE_SERIES))
                .join(l4, F.col("pi_website_category_l4_fk") == F.col("pi_website_category_l4_pk")).where(keep))
        return once.select("pi_product_pk", "pi_website_category_l1_desc", "pi_website_category_l3_fk",
                           category_index("pi_website_category_l1_desc").alias("spend_category"))
    product = src["product"].select(F.col("pi_product_pk").alias("_p_pk"),
                                    F.col("pi_range_subsection_fk").alias("_p_range"))
    subsection = broadcast_if(src["range_subsection"].select("pi_range_subsection_pk"),
                        bounds.get("range_subsection", False))
    cats = category_list(hierarchy)
    gate = (hierarchy.select("pi_product_pk", "pi_website_category_l1_desc",
                             "pi_website_category_l3_fk", "pi_website_category_l2_fk")
            .join(product, F.col("pi_product_pk") == F.col("_p_pk"), "inner")
            .join(subsection, F.col("_p_range") == subsection.pi_range_subsection_pk, "inner"))
    gate = category_filter(gate, cats, p.l2_categories, bounds.get("web_category_l4", False))
    return gate.select("pi_product_pk", "pi_website_category_l1_desc", "pi_website_category_l3_fk",
                       category_index("pi_website_category_l1_desc").alias("spend_category"))


def item_base(src: Sources, p: RunParams, hierarchy: DataFrame | None = None,
              bounds: Bounds | None = None) -> DataFrame:
    """Line items in the run window of the retail transaction types, in the
    filtered category list, with channel/date existence checks -- the star
    join shared by entity spend and category spend (one definition).

    The fact side is scanned once with literal date bounds (pushed to the
    scan); every dimension is broadcast only behind a row-count bound
    (``star_bounds``, one job for all of them).
    """
    bounds = bounds if bounds is not None else star_bounds(src, p)
    hierarchy = hierarchy if hierarchy is not None else product_hierarchy(src, bounds)
    dims = star_dimensions(src, p)
    items = src["trans_item"].where(in_range("trans_date", p.start_date, p.end_date))
    gate = broadcast_if(product_gate(src, hierarchy, p, bounds), bounds["product_gate"])
    dates = broadcast_if(dims["date_dim"], bounds["date_dim"])
    chans = broadcast_if(dims["channel"], bounds["channel"])
    types = broadcast_if(dims["trans_type"], bounds["trans_type"])
    return (items
            .join(gate, items.pi_product_fk == gate.pi_product_pk, "inner")
            .join(dates, items.trans_date == dates.date_key, "inner")
            .join(chans, items.pi_channel_fk == chans.pi_channel_pk, "inner")
            .join(types, items.pi_trans_type_fk == types.pi_trans_type_pk, "inner")
            .select(*ITEM_COLUMNS, "spend_category"))
