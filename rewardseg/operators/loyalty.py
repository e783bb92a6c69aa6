"""Loyalty-use flags per transaction: in-store tenders and online card links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rewardseg import fixed_values as fv
from rewardseg.functions import in_range
from rewardseg.operators.joins import left_join_spreading_nulls
from rewardseg.params import RunParams
from rewardseg.sources import Sources


def tender_transactions(tender: DataFrame, tender_type: int) -> DataFrame:
    """Distinct transactions paid (partly) with ``tender_type``."""
    return (tender.where(F.col("pi_tender_type_fk") == tender_type)
            .select("pi_trans_fk").distinct())


def _window_trans(src: Sources, p: RunParams) -> DataFrame:
    return src["trans"].where(in_range("trans_date", p.start_date, p.end_date))


def registered_reservations(src: Sources) -> DataFrame:
    r = src["reservation"]
    return (r.where((r.is_registered_user == 1) & (r.is_prepaid == 1))
            .select("pi_res_pk", "res_datetime", F.col("pi_cust_identifier_fk").alias("res_cust_fk")))


def registered_deliveries(src: Sources) -> DataFrame:
    h = src["home_delivery"]
    return (h.where(h.is_registered_user == 1)
            .select("delivery_order_pk", "order_datetime", F.col("pi_cust_identifier_fk").alias("hd_cust_fk")))


def reservation_left_join(src: Sources, p: RunParams) -> DataFrame:
    """Transactions left-joined to registered, prepaid reservations (the
    constant predicates of the ON clause filter the right side first)."""
    t, r = _window_trans(src, p), registered_reservations(src)
    return (left_join_spreading_nulls(t, r, "pi_res_fk", "pi_res_pk", spread="pi_trans_pk")
            .select("pi_trans_pk", "pi_res_fk", "res_datetime", "res_cust_fk"))


def delivery_left_join(src: Sources, p: RunParams) -> DataFrame:
    t, h = _window_trans(src, p), registered_deliveries(src)
    return (left_join_spreading_nulls(t, h, "delivery_order_id", "delivery_order_pk", spread="pi_trans_pk")
            .select("pi_trans_pk", "delivery_order_id", "order_datetime", "hd_cust_fk"))


def online_orders(src: Sources, p: RunParams) -> DataFrame:
    """Transactions with their online order date and the account behind the
    customer identifier ``COALESCE(reservation, delivery)``.

    A transaction with neither key cannot reach the inner identifier join,
    so it is filtered out before the two outer joins; in each outer join the
    transactions holding only the other key (NULL here) are spread by their
    own key instead of piling into one partition.
    """
    t = _window_trans(src, p).where(F.col("pi_res_fk").isNotNull() | F.col("delivery_order_id").isNotNull())
    r, h = registered_reservations(src), registered_deliveries(src)
    w = src["cust_identifier"].select("pi_cust_identifier_pk", "pi_account_id_fk")
    j = left_join_spreading_nulls(t, r, "pi_res_fk", "pi_res_pk", spread="pi_trans_pk")
    j = (left_join_spreading_nulls(j, h, "delivery_order_id", "delivery_order_pk", spread="pi_trans_pk")
         .select("pi_trans_pk",
                 F.to_date(F.coalesce("res_datetime", "order_datetime")).alias("order_date"),
                 F.coalesce("res_cust_fk", "hd_cust_fk").alias("_ident")))
    return (j.join(w, j._ident == w.pi_cust_identifier_pk, "inner")
            .select("pi_trans_pk", "order_date", F.col("pi_account_id_fk").alias("account_id")))


def links_valid_per_day(orders: DataFrame, history: DataFrame, grace_days: int) -> DataFrame:
    """Number of card-history rows valid for each (account, order date).

    A history row counts for order date ``d`` when ``link <= d + grace`` and
    (``unlink >= d`` or ``unlink`` is NULL), i.e. ``d`` lies in
    ``[link - grace, unlink]``.  Instead of pairing every order with every
    card row of its account (quadratic for a hot account), this is a sweep:
    per account, +n at each interval start day, -n the day after each end,
    and a running sum read at the order days.  Starts, ends and order days
    are aggregated to (account, day) first, so a window partition holds at
    most a few rows per calendar day of one account whatever its volume.
    """
    h = history.select(F.col("pi_myaccount_fk").alias("account_id"),
                       F.date_sub(F.to_date("card_link_datetime"), grace_days).alias("start"),
                       F.to_date("card_unlink_datetime").alias("end"))
    h = h.where(F.col("start").isNotNull() & (F.col("end").isNull() | (F.col("end") >= F.col("start"))))
    one = F.lit(1).cast("bigint")
    starts = h.select("account_id", F.col("start").alias("day"), one.alias("delta"), F.lit(0).alias("ask"))
    ends = (h.where(F.col("end").isNotNull())
            .select("account_id", F.date_add("end", 1).alias("day"), (-one).alias("delta"), F.lit(0).alias("ask")))
    asks = (orders.where(F.col("order_date").isNotNull())
            .select("account_id", F.col("order_date").alias("day"), (one * 0).alias("delta"), F.lit(1).alias("ask")))
    # One row per (account, day): summed deltas, and whether an order asks there.
    events = (starts.unionByName(ends).unionByName(asks)
              .groupBy("account_id", "day").agg(F.sum("delta").alias("delta"), F.max("ask").alias("ask")))
    running = (Window.partitionBy("account_id").orderBy("day")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (events.withColumn("n_links", F.sum("delta").over(running))
            .where((F.col("ask") == 1) & (F.col("n_links") > 0))
            .select("account_id", F.col("day").alias("order_date"), "n_links"))


def _link_rows(src: Sources, p: RunParams, orders: DataFrame | None = None) -> DataFrame:
    """(transaction, order date, valid links) per identifier match.  The
    orders are read twice (for the days the sweep is asked about, and to
    join its answers), so a caller with a staged copy passes it."""
    orders = online_orders(src, p) if orders is None else orders
    per_day = links_valid_per_day(orders, src["card_history"], p.grace_days)
    return orders.join(per_day, ["account_id", "order_date"], "inner")


def online_links(src: Sources, p: RunParams, orders: DataFrame | None = None) -> DataFrame:
    """Per transaction: its order date and how many (identifier, card-history)
    rows satisfy the link validity rule -- the row multiplicity the online
    loyalty subquery has for that transaction.  Only transactions with at
    least one valid link are returned."""
    return (_link_rows(src, p, orders).groupBy("pi_trans_pk", "order_date")
            .agg(F.sum("n_links").alias("n_links")))


def online_link_rows(links: DataFrame) -> DataFrame:
    """The subquery's rows as written: ``n_links`` copies per transaction."""
    return (links.select("pi_trans_pk", "order_date",
                         F.explode(F.array_repeat(F.lit(1), F.col("n_links").cast("int"))).alias("_one"))
            .drop("_one"))


def tender_flags(src: Sources) -> DataFrame:
    """Per transaction with a loyalty tender: in-store loyalty and redemption
    flags.  Over tenders bucketed on the transaction this needs no shuffle."""
    t = F.col("pi_tender_type_fk")
    return (src["trans_tender"].where(t.isin(fv.TENDER_LOYALTY_INSTORE, fv.TENDER_REDEMPTION_INSTORE)).groupBy("pi_trans_fk")
            .agg(F.max(F.when(t == fv.TENDER_LOYALTY_INSTORE, 1).otherwise(0)).alias("loyalty_instore"),
                 F.max(F.when(t == fv.TENDER_REDEMPTION_INSTORE, 1).otherwise(0)).alias("instore_red")))


def online_flags(src: Sources, p: RunParams, dedup_online: bool = False, orders: DataFrame | None = None) -> DataFrame:
    """Per transaction with a valid online link: the online flag and the
    multiplicity of the (non-distinct) online join."""
    rows = _link_rows(src, p, orders)
    if dedup_online:
        rows = rows.select("pi_trans_pk", "order_date", F.lit(1).alias("n_links")).distinct()
    per_trans = rows.groupBy(F.col("pi_trans_pk").alias("pi_trans_fk")).agg(F.sum("n_links").cast("bigint").alias("multiplicity"))
    return per_trans.select("pi_trans_fk", F.lit(1).alias("loyalty_online"), "multiplicity")


def transaction_flags(src: Sources, p: RunParams, dedup_online: bool = False,
                      orders: DataFrame | None = None) -> DataFrame:
    """Per transaction: in-store loyalty and redemption flags, online flag and
    the multiplicity its line items get from the (non-distinct) online join.

    Tender rows and link rows are unioned and aggregated once on the
    transaction key: a single shuffle (partial aggregation before it), and
    the result stays hash-partitioned on the key the line items join on.
    ``dedup_online=True`` treats the online subquery as DISTINCT.
    """
    t = F.col("pi_tender_type_fk")
    tender = (src["trans_tender"].where(t.isin(fv.TENDER_LOYALTY_INSTORE, fv.TENDER_REDEMPTION_INSTORE))
              .select("pi_trans_fk",
                      F.when(t == fv.TENDER_LOYALTY_INSTORE, 1).otherwise(0).alias("loyalty_instore"),
                      F.when(t == fv.TENDER_REDEMPTION_INSTORE, 1).otherwise(0).alias("instore_red"),
                      F.lit(0).cast("bigint").alias("n_links")))
    rows = _link_rows(src, p, orders)
    if dedup_online:  # the distinct subquery has a row per order date of a transaction
        rows = rows.select("pi_trans_pk", "order_date", F.lit(1).alias("n_links")).distinct()
    links = rows.select(F.col("pi_trans_pk").alias("pi_trans_fk"),
                        F.lit(0).alias("loyalty_instore"), F.lit(0).alias("instore_red"),
                        F.col("n_links").cast("bigint").alias("n_links"))
    per_trans = (tender.unionByName(links).groupBy("pi_trans_fk")
                 .agg(F.max("loyalty_instore").alias("loyalty_instore"),
                      F.max("instore_red").alias("instore_red"),
                      F.sum("n_links").alias("n_links")))
    n = F.col("n_links")
    mult = F.greatest(n, F.lit(1))
    return per_trans.select(
        "pi_trans_fk", "loyalty_instore", F.when(n > 0, 1).otherwise(0).alias("loyalty_online"),
        "instore_red", mult.cast("bigint").alias("multiplicity"))
