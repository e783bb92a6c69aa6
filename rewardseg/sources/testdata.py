"""The 20 sources derived from the TPC-H-like test tables (FIXTURES.md).

Every source is a Spark projection/filter/union of the given parquet tables,
so its size grows with the scale factor.  The formulas are the ones listed in
FIXTURES.md; ``rewardseg.plans.oracle`` holds the same derivations in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rewardseg.params import RunParams
from rewardseg.sources.catalog import Sources

# Level-1 category label by (l4 key mod 13); the last one matches no category.
L1_LABELS = (
    "Baby and Nursery", "Appliances", "Clothing", "Home and garden", "Garden and DIY",
    "Home and furniture", "Toys", "Jewellery and Watches", "Sports and leisure",
    "Health and beauty", "Technology", "Gifts", "Other",
)
TRANS_TYPE_LABELS = (
    "Walk-in", "FastTrack Reservation", "Reservation Collection", "Home Delivery",
    "FastTrack Home Delivery", "Refund", "Staff",
)
SUPPLIER_OTHER = "OTHER"


def _label(key: Column, labels: tuple[str, ...]) -> Column:
    out = F
    for i, label in enumerate(labels):
        out = out.when(key == i, F.lit(label))
    return out


def _gender(custkey: Column) -> Column:
    g = custkey % 4
    return F.when(g == 0, "F").when(g == 1, "M").when(g == 2, "U")


def _date(s: str) -> Column:
    return F.lit(dt.date.fromisoformat(s))


def testdata_sources(spark: SparkSession, sf_dir: str, params: RunParams) -> Sources:
    tables: dict[str, DataFrame] = {}

    def t(name: str) -> DataFrame:
        # One read (file listing + footer) per table; every derivation shares it.
        if name not in tables:
            tables[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return tables[name]

    def date_dim():
        d = F.col("date_key")
        prev_start = params.week_start - dt.timedelta(days=7)
        prev_end = params.week_start - dt.timedelta(days=1)
        return (t("orders").select(F.col("o_orderdate").cast("date").alias("date_key")).distinct()
                .select(d,
                        (F.year(d) * 100 + F.month(d)).cast("int").alias("fin_period_no"),
                        (F.floor((F.dayofmonth(d) - 1) / 7).cast("int") + 1).alias("week_no"),
                        F.when(d.between(F.lit(prev_start), F.lit(prev_end)), -1).otherwise(0)
                        .alias("relative_week")))

    def burn_fact():
        o = t("orders")
        a = F.when(o.o_custkey % 3 == 0, o.o_custkey % 300).otherwise(o.o_custkey)
        points = F.floor(o.o_totalprice * o.o_totalprice / (F.lit(3.6e7) * (1 + a % 4)))
        return o.select(
            a.alias("account_number"),
            points.cast("bigint").alias("tran_points"),
            o.o_orderdate.cast("date").alias("tran_date"),
            F.when(o.o_orderpriority == "5-LOW", SUPPLIER_OTHER)
             .otherwise(params.supplier_code).alias("supplier_id"),
            F.when(o.o_orderstatus == "P", "RX").otherwise("RC").alias("redemption_status"),
            F.when(o.o_orderkey % 20 == 0, "XX").otherwise("DL").alias("reason_code"))

    def data_profile():
        c, n, r = t("customer"), t("nation"), t("region")
        return (c.where(c.c_custkey % 11 != 0)
                .join(n, c.c_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select(c.c_custkey.alias("account_number"),
                        F.concat(F.lit("B"), (c.c_custkey % 6).cast("string")).alias("age_band"),
                        _gender(c.c_custkey).alias("gender"),
                        r.r_name.alias("region"),
                        c.c_mktsegment.alias("acorn_category"),
                        F.floor(c.c_acctbal).cast("bigint").alias("total_points")))

    def product():
        p = t("part")
        return p.select(p.p_partkey.alias("pi_product_pk"), F.lit(1).alias("is_live"),
                        p.p_name.alias("short_desc"),
                        p.p_size.alias("pi_range_subsection_fk"),
                        (p.p_partkey % 40).alias("pi_website_category_l4_fk"))

    def range_subsection():
        s = F.col("p_size")
        return (t("part").select("p_size").distinct().where(s != 47)
                .select(s.alias("pi_range_subsection_pk"),
                        F.when(s % 10 == 0, 135).when(s % 10 == 1, F.lit(None))
                        .otherwise(s).cast("int").alias("pi_range_series_fk")))

    def web_category_l4():
        k = F.col("k")
        txt = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
        return (t("part").select((F.col("p_partkey") % 40).alias("k")).distinct().where(k != 39)
                .select(k.alias("pi_website_category_l4_pk"),
                        txt("L4 ", k).alias("pi_website_category_l4_desc"),
                        (k % 20).alias("pi_website_category_l3_fk"),
                        txt("L3 ", k % 20).alias("pi_website_category_l3_desc"),
                        (k % 5).alias("pi_website_category_l2_fk"),
                        txt("L2 ", k % 5).alias("pi_website_category_l2_desc"),
                        (k % 13).alias("pi_website_category_l1_fk"),
                        _label(k % 13, L1_LABELS).alias("pi_website_category_l1_desc"),
                        (k % 7).alias("pi_buying_category_fk"),
                        txt("CMI ", k % 7).alias("pi_buying_category_desc"),
                        txt("/browse/", k).alias("website_category_url")))

    def trans_item():
        li, o = t("lineitem"), t("orders")
        sign = F.when((li.l_returnflag == "R") & (li.l_linenumber % 5 == 0), -1).otherwise(1)
        money = (sign * F.floor(li.l_extendedprice / 10).cast("int") * F.lit(0.01).cast("decimal(2,2)"))
        # some lines of loyalty transactions come once more without an entity
        again = (li.l_linenumber == 1) & (li.l_suppkey % 4 == 0) & (li.l_orderkey % 50 == 3)
        entity = F.explode(F.when(again, F.array(o.o_custkey, F.lit(None).cast("bigint"))).otherwise(F.array(o.o_custkey)))
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(entity.alias("pi_entity_fk"), li.l_orderkey.alias("pi_trans_fk"),
                        li.l_partkey.alias("pi_product_fk"),
                        o.o_orderdate.cast("date").alias("trans_date"),
                        (li.l_linenumber % 3).alias("pi_channel_fk"),
                        (li.l_suppkey % 7).cast("int").alias("pi_trans_type_fk"),
                        money.cast("decimal(12,2)").alias("line_total")))

    def channel():
        return t("lineitem").select((F.col("l_linenumber") % 3).alias("pi_channel_pk")).distinct()

    def trans_type():
        k = F.col("pi_trans_type_pk")
        return (t("lineitem").select((F.col("l_suppkey") % 7).cast("int").alias("pi_trans_type_pk"))
                .distinct().select(k, _label(k, TRANS_TYPE_LABELS).alias("pi_trans_type_desc")))

    def trans_tender():
        li = t("lineitem")
        return li.select(
            li.l_orderkey.alias("pi_trans_fk"),
            F.when((li.l_linenumber == 1) & (li.l_suppkey % 4 == 0), 255)
             .when((li.l_linenumber == 2) & (li.l_suppkey % 10 == 0), 37)
             .otherwise(1).alias("pi_tender_type_fk"))

    def trans():
        o = t("orders")
        return o.select(o.o_orderkey.alias("pi_trans_pk"), o.o_orderdate.cast("date").alias("trans_date"),
                        F.when(o.o_orderkey % 3 == 0, o.o_orderkey).alias("pi_res_fk"),
                        F.when(o.o_orderkey % 3 == 1, o.o_orderkey).alias("delivery_order_id"))

    def reservation():
        o = t("orders")
        # some reservations are there twice, a day apart
        dates = F.when(o.o_orderkey % 60 == 0, F.array(o.o_orderdate, o.o_orderdate + F.expr("interval 1 day"))).otherwise(
            F.array(o.o_orderdate))
        return o.where(o.o_orderkey % 3 == 0).select(
            o.o_orderkey.alias("pi_res_pk"), F.explode(dates).alias("res_datetime"),
            F.when(o.o_orderpriority == "1-URGENT", 0).otherwise(1).alias("is_registered_user"),
            F.when(o.o_orderstatus == "P", 0).otherwise(1).alias("is_prepaid"),
            o.o_custkey.alias("pi_cust_identifier_fk"))

    def home_delivery():
        o = t("orders")
        return o.where(o.o_orderkey % 3 == 1).select(
            o.o_orderkey.alias("delivery_order_pk"), o.o_orderdate.alias("order_datetime"),
            F.when(o.o_orderstatus == "F", 1).otherwise(0).alias("is_registered_user"),
            o.o_custkey.alias("pi_cust_identifier_fk"))

    def cust_identifier():
        c = t("customer")
        return c.select(c.c_custkey.alias("pi_cust_identifier_pk"), c.c_custkey.alias("pi_entity_fk"),
                        c.c_custkey.alias("pi_account_id_fk"))

    def card_history():
        c = t("customer")
        k = c.c_custkey
        first = c.select(
            k.alias("pi_myaccount_fk"),
            F.when(k % 8 == 0, k % 80).otherwise(k).alias("pi_loyalty_card_fk"),
            F.date_add(_date("1996-01-01"), (k % 1500).cast("int")).alias("card_link_datetime"),
            F.when(k % 4 == 1, F.date_add(_date("1999-01-01"), (k % 700).cast("int")))
             .alias("card_unlink_datetime"))
        second = c.where(k % 45 == 7).select(
            k.alias("pi_myaccount_fk"), (k + 1).alias("pi_loyalty_card_fk"),
            _date("1997-06-01").alias("card_link_datetime"),
            F.lit(None).cast("date").alias("card_unlink_datetime"))
        return first.unionByName(second)

    def customer_profiling():
        c = t("customer")
        return c.where(c.c_custkey % 13 != 0).select(c.c_custkey.alias("entitykey"),
                                                     _gender(c.c_custkey).alias("gender"))

    def value_score():
        c = t("customer")
        k = c.c_custkey
        base = c.where(k % 7 != 0).select(k.alias("entitykey"), (k % 10).cast("int").alias("s"),
                                          _date("2000-12-15").alias("run_date"))
        second = c.where(k % 50 == 1).select(k.alias("entitykey"), (k % 10 + 1).cast("int").alias("s"),
                                             _date("2000-12-20").alias("run_date"))
        stale = c.select(k.alias("entitykey"), F.lit(99).alias("s"), _date("2000-11-15").alias("run_date"))
        return (base.unionByName(second).unionByName(stale)
                .withColumnRenamed("s", "current_value_score"))

    history: list[DataFrame] = []

    def cards():
        if not history:
            history.append(card_history())
        return history[0].select(F.col("pi_loyalty_card_fk").alias("pk")).distinct()

    def loyalty_card():
        return cards().select(F.col("pk").alias("pi_loyalty_card_pk"),
                              F.md5(F.col("pk").cast("string")).alias("loyalty_card_hashed"))

    def card_mapping():
        h = F.md5(F.col("pk").cast("string"))
        return cards().where(F.col("pk") % 17 != 3).select(
            h.alias("retailer_card_hash"), F.md5(F.concat(F.lit("L"), h)).alias("loyalty_card_hash"))

    def full_card():
        h = F.md5(F.col("pk").cast("string"))
        return cards().select(F.col("pk").alias("account_number"),
                              F.md5(F.concat(F.lit("L"), h)).alias("loyalty_id"))

    return Sources({
        "date_dim": date_dim, "burn_fact": burn_fact, "data_profile": data_profile,
        "product": product, "range_subsection": range_subsection,
        "web_category_l4": web_category_l4, "trans_item": trans_item, "channel": channel,
        "trans_type": trans_type, "trans_tender": trans_tender, "trans": trans,
        "reservation": reservation, "home_delivery": home_delivery,
        "cust_identifier": cust_identifier, "card_history": card_history,
        "customer_profiling": customer_profiling, "value_score": value_score,
        "loyalty_card": loyalty_card, "card_mapping": card_mapping, "full_card": full_card,
    })
