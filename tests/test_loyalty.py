"""Online link validity: the sweep against the literal pairwise join."""

import datetime as dt
import random

from pyspark.sql import functions as F

from rewardseg.functions import valid_on
from rewardseg.operators.loyalty import links_valid_per_day

D = dt.date


def brute_force(spark, orders, history, grace):
    """The rule as written: every (order, history row) pair of an account."""
    o, h = orders.alias("o"), history.alias("h")
    cond = ((F.col("o.account_id") == F.col("h.pi_myaccount_fk"))
            & (F.to_date("h.card_link_datetime") <= F.date_add("o.order_date", grace))
            & valid_on(F.to_date("h.card_unlink_datetime"), F.col("o.order_date")))
    return (o.join(h, cond, "inner").groupBy("o.account_id", "o.order_date")
            .agg(F.count(F.lit(1)).alias("n_links")))


def _frames(spark, orders, history):
    o = spark.createDataFrame(orders, "account_id long, order_date date")
    h = spark.createDataFrame(history, "pi_myaccount_fk long, pi_loyalty_card_fk long, "
                                       "card_link_datetime date, card_unlink_datetime date")
    return o, h


def _as_set(df):
    return {(r["account_id"], r["order_date"], r["n_links"]) for r in df.collect()}


def test_boundaries(spark):
    d = D(2000, 6, 15)
    orders = [(1, d), (2, d), (3, d), (4, d), (5, d), (6, None)]
    history = [
        (1, 10, d + dt.timedelta(days=22), None),          # link = order + 22 -> valid
        (2, 20, d + dt.timedelta(days=23), None),          # link = order + 23 -> not
        (3, 30, D(1999, 1, 1), d),                         # unlink = order -> valid
        (4, 40, D(1999, 1, 1), d - dt.timedelta(days=1)),  # unlink = order - 1 -> not
        (5, 50, D(1999, 1, 1), None), (5, 51, D(1999, 2, 1), None),  # two open cards
        (6, 60, D(1999, 1, 1), None),                      # order without a date
    ]
    o, h = _frames(spark, orders, history)
    got = _as_set(links_valid_per_day(o, h, 22))
    assert got == {(1, d, 1), (3, d, 1), (5, d, 2)}
    assert got == _as_set(brute_force(spark, o, h, 22))


def test_random_hot_account_matches_brute_force(spark):
    rng = random.Random(7)
    base = D(1998, 1, 1)
    orders, history = [], []
    for i in range(3000):
        acct = 0 if i % 3 == 0 else rng.randrange(1, 60)   # a third of orders on account 0
        orders.append((acct, base + dt.timedelta(days=rng.randrange(0, 900))))
    for i in range(600):
        acct = 0 if i % 3 == 0 else rng.randrange(1, 60)
        link = base + dt.timedelta(days=rng.randrange(-100, 900))
        unlink = None if rng.random() < 0.4 else link + dt.timedelta(days=rng.randrange(-40, 400))
        history.append((acct, i, link, unlink))
    o, h = _frames(spark, orders, history)
    assert _as_set(links_valid_per_day(o, h, 22)) == _as_set(brute_force(spark, o.distinct(), h, 22))
