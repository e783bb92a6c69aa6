"""FIXTURES.md goldens at sf0.01 (as-written semantics)."""

from decimal import Decimal

from pyspark.sql import functions as F

from rewardseg import fixed_values as fv
from rewardseg.operators import bands, linking, profile


def test_redemptions(run_check):
    r = run_check.redemptions.agg(F.count(F.lit(1)), F.sum("tran_points"), F.min("tran_date"),
                                  F.max("tran_date")).first()
    assert (r[0], r[1], str(r[2]), str(r[3])) == (5628, 7104777, "1996-01-02", "2000-12-31")


def test_segments(run_check):
    got = {r["segment"]: r["count"] for r in run_check.segments.groupBy("segment").count().collect()}
    assert got == {"INFREQUENT": 454, "LARGE_RED": 33, "L_X_BF": 61, "MID_RED_HIGH": 40, "MID_RED_MID": 84,
                   "MID_RED_LOW": 74, "MID_RED_SINGLE": 3, "SMALL_RED_HIGH": 30, "SMALL_RED_MID": 119,
                   "SMALL_RED_LOW": 159, "SMALL_RED_SINGLE": 17}


def test_season_by_this_year(run_check):
    got = {(r[0], r[1]): r[2] for r in
           run_check.groups.groupBy("xmas_bf_reder", "red_this_year").count().collect()}
    assert got == {("NO_XMAS_BF", 0): 261, ("NO_XMAS_BF", 1): 247, ("XMAS_BF", 0): 193, ("XMAS_BF", 1): 373}


def test_week_marker_and_profile_base(run_check):
    got = sorted((r[0], r[1], str(r[2])) for r in run_check.week_marker.collect())
    assert got == [(200012, 3, "2000-12-21"), (200012, 4, "2000-12-24")]
    assert run_check.profile_base.count() == 976


def test_items(run_check):
    r = run_check.items.agg(F.count(F.lit(1)), F.sum("line_total")).first()
    assert (r[0], r[1]) == (26937, Decimal("1289857.19"))
    assert run_check.hierarchy.count() == 1758


def test_entity_spend_by_flags(run_check):
    got = {(r[0], r[1], r[2]): (r[3], r[4]) for r in run_check.entity_spend()
           .groupBy("loyalty_instore", "loyalty_online", "instore_red")
           .agg(F.count(F.lit(1)), F.sum("spend")).collect()}
    assert got == {
        (0, 0, 0): (1482, Decimal("835762.32")), (0, 0, 1): (378, Decimal("62565.80")),
        (0, 1, 0): (844, Decimal("164948.65")), (0, 1, 1): (98, Decimal("14299.95")),
        (1, 0, 0): (798, Decimal("170180.66")), (1, 0, 1): (74, Decimal("13730.39")),
        (1, 1, 0): (219, Decimal("36305.47")), (1, 1, 1): (14, Decimal("2994.75"))}
    assert run_check.eligible.count() == 1820


def test_category_spend_and_fanout_law(run_check):
    written, dedup = run_check.category_spend(), run_check.category_spend(dedup=True)
    a = written.agg(F.count(F.lit(1)), F.sum("total_spend")).first()
    b = dedup.agg(F.count(F.lit(1)), F.sum("total_spend")).first()
    assert (a[0], a[1]) == (1207, Decimal("1747534.40"))
    assert (b[0], b[1]) == (1207, Decimal("1110519.58"))
    sums = written.agg(*[F.sum(c) for c in fv.SPEND_COLUMNS]).first()
    assert [str(x) for x in sums] == ["95233.15", "141483.88", "148385.84", "293714.14", "145128.36",
                                      "135891.44", "91130.69", "139752.11", "143626.49", "136289.49",
                                      "133040.96"]
    # as written = dedup x eligible rows of the entity, for every entity
    rows = run_check.eligible.groupBy("pi_entity_fk").count()
    law = (written.alias("w").join(dedup.alias("d"), "pi_entity_fk").join(rows, "pi_entity_fk")
           .where(F.col("w.total_spend") != F.col("d.total_spend") * F.col("count")))
    assert law.count() == 0
    per_entity = {r[0]: r[1] for r in rows.groupBy("count").count().collect()}
    # one of the twos is the group of lines without an entity, which has no category spend
    assert per_entity == {1: 661, 2: 482, 3: 65}
    assert written.where("pi_entity_fk is null").count() == dedup.where("pi_entity_fk is null").count() == 0
    assert run_check.entity_spend().where("pi_entity_fk is null").count() > 0


def test_band_distribution(run_check):
    bands_df = profile.spend_bands(run_check.category_spend())
    tech = {r[0]: r[1] for r in bands_df.groupBy("technology_spend_band").count().collect()}
    assert tech == {1: 313, 2: 89, 3: 138, 4: 353, 6: 283, None: 31}
    gifts = {r[0]: r[1] for r in bands_df.groupBy("gifts_spend_band").count().collect()}
    assert gifts == {1: 313, 2: 26, 3: 36, 4: 45, 5: 746, None: 41}


def test_profile_and_links(run_check):
    assert run_check.retail_profile.count() == 1226
    assert run_check.link_loyalty.count() == 909
    assert run_check.link_account.count() == 909
    card = {r[0]: r[1] for r in linking.link_cardinality(run_check.link_account).collect()}
    assert card[1] == 714 and card[2] == 13 and sum(v for k, v in card.items() if k >= 10) == 10
    assert linking.link_rank(run_check.link_account, 1).count() == 737


def test_snapshot(run_check):
    snap = run_check.snapshot
    r = snap.agg(F.count(F.lit(1)), F.countDistinct("account_number"), F.countDistinct("pi_entity_fk"),
                 F.sum("total_spend"), F.sum("points_balance")).first()
    assert tuple(r) == (652, 497, 630, Decimal("976970.74"), 2690660)
    pairs = {r[0]: r[1] for r in snap.groupBy("pi_entity_fk", "account_number").count()
             .groupBy("count").count().collect()}
    assert pairs == {1: 640, 2: 6}
    assert len(snap.columns) == 22


def test_ntile_bands_cover_every_row(run_check):
    long = bands.spend_long(run_check.category_spend())
    tiles = bands.ntile_bands(long, n=5, max_groups=len(fv.CATEGORY_NAMES))
    assert tiles.count() == 1207 * 11
    assert {r[0] for r in tiles.select("spend_ntile").distinct().collect()} == {1, 2, 3, 4, 5}
