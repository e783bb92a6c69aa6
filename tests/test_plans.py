"""Plan checks and the null/outer-join cases of the product star."""

import datetime as dt
import re
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from rewardseg.operators import products
from rewardseg.params import RunParams
from rewardseg.plans.pipeline import Run
from rewardseg.sources import SOURCE_NAMES, Sources
from rewardseg.sources import testdata_sources as derive_sources


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _explain(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_staged_run_reads_checkpoint(run_check):
    """The shared run stages category spend; later steps do not rescan items."""
    assert "l_extendedprice" not in _plan(run_check.snapshot)


def test_snapshot_plan_shape(run_check):
    plan = _plan(run_check.snapshot)
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_line_items_scanned_once(spark):
    """Unstaged, the whole snapshot plan still reads the line items once."""
    from conftest import SF_CHECK
    from rewardseg.plans.registry import make_run
    text = _plan(make_run(spark, SF_CHECK, staging="view").snapshot)
    # the trans_item fixture is the only reader of l_extendedprice
    assert text.count("l_extendedprice") >= 1
    scans = [ln for ln in text.splitlines() if "FileScan parquet" in ln and "l_extendedprice" in ln]
    assert len(scans) == 1, scans


def test_parquet_sources_push_filters_and_agree(spark):
    """Sources stored as parquet (the deployment shape): the run's date window
    reaches the fact scans as pushed filters, and results equal the run over
    the derived sources."""
    params = RunParams(as_of=dt.date(2000, 12, 31), start_year=1996)
    derived = derive_sources(spark, "/root/testdata/sf0.001", params)
    root = tempfile.mkdtemp(prefix="rewardseg-src-")
    for name in SOURCE_NAMES:
        derived[name].write.parquet(f"{root}/{name}")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        run = Run(Sources.from_parquet(spark, root), params)
        fact = [ln for ln in _explain(run.items).splitlines() if "PushedFilters" in ln and "trans_date" in ln]
        burn = [ln for ln in _explain(run.redemptions).splitlines() if "PushedFilters" in ln]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(fact) == 1
    assert f"GreaterThanOrEqual(trans_date,{run.p.start_date})" in fact[0]
    assert "LessThanOrEqual(trans_date,2000-12-31)" in fact[0]
    assert "EqualTo(redemption_status,RC)" in burn[0] and "GreaterThan(tran_points,0)" in burn[0]
    ref = Run(derived, params).snapshot
    got = run.snapshot
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def _star_sources(spark):
    d = dt.date(2000, 6, 1)
    money = Decimal("10.00")
    tables = {
        # product 1: series 135 (excluded); 2: NULL series (kept); 3: no subsection row
        # (kept by the hierarchy, dropped by the item star); 4: ordinary
        "product": spark.createDataFrame([(1, 1, "a", 10, 1), (2, 1, "b", 11, 1), (3, 1, "c", 99, 1),
                                          (4, 1, "d", 12, 1)],
                                         "pi_product_pk long, is_live int, short_desc string, "
                                         "pi_range_subsection_fk int, pi_website_category_l4_fk long"),
        "range_subsection": spark.createDataFrame([(10, 135), (11, None), (12, 12)],
                                                 "pi_range_subsection_pk int, pi_range_series_fk int"),
        "web_category_l4": spark.createDataFrame(
            [(1, "x", 5, "x", 1, "x", 1, "Toys", 1, "x", "u")],
            "pi_website_category_l4_pk long, pi_website_category_l4_desc string, "
            "pi_website_category_l3_fk long, pi_website_category_l3_desc string, "
            "pi_website_category_l2_fk long, pi_website_category_l2_desc string, "
            "pi_website_category_l1_fk long, pi_website_category_l1_desc string, "
            "pi_buying_category_fk long, pi_buying_category_desc string, website_category_url string"),
        "trans_item": spark.createDataFrame([(7, 100 + p, p, d, 0, 0, money) for p in (1, 2, 3, 4)],
                                            "pi_entity_fk long, pi_trans_fk long, pi_product_fk long, "
                                            "trans_date date, pi_channel_fk int, pi_trans_type_fk int, "
                                            "line_total decimal(12,2)"),
        "date_dim": spark.createDataFrame([(d, 200006, 1, 0)],
                                          "date_key date, fin_period_no int, week_no int, relative_week int"),
        "channel": spark.createDataFrame([(0,)], "pi_channel_pk int"),
        "trans_type": spark.createDataFrame([(0, "Walk-in")], "pi_trans_type_pk int, pi_trans_type_desc string"),
    }
    return Sources({k: (lambda v=v: v) for k, v in tables.items()})


def test_hierarchy_null_series_and_unmatched_subsection(spark):
    src = _star_sources(spark)
    p = RunParams(as_of=dt.date(2000, 12, 31), start_year=2000, start_date=dt.date(2000, 1, 1))
    hierarchy = products.product_hierarchy(src)
    assert sorted(r[0] for r in hierarchy.select("pi_product_pk").collect()) == [2, 3, 4]
    items = products.item_base(src, p)
    assert sorted(r[0] for r in items.select("pi_product_fk").collect()) == [2, 4]
    assert {r[0] for r in items.select("spend_category").collect()} == {5}
    assert items.agg(F.sum("line_total")).first()[0] == Decimal("20.00")


def test_link_rank_limits_before_the_shuffle(run_check):
    from rewardseg.operators import linking
    plan = _plan(linking.link_rank(run_check.link_account, 1))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_duplicate_product_key_falls_back_to_counting_the_gate(spark):
    src = _star_sources(spark)
    dup = src["product"].unionByName(src["product"].where("pi_product_pk = 4"))
    tables = {name: src[name] for name in src}
    tables["product"] = dup
    src2 = Sources({k: (lambda v=v: v) for k, v in tables.items()})
    p = RunParams(as_of=dt.date(2000, 12, 31), start_year=2000, start_date=dt.date(2000, 1, 1))
    bounds = products.star_bounds(src2, p)
    assert bounds["product_gate"] is True
    # as written: two hierarchy rows x two product rows for product 4
    items = products.item_base(src2, p, bounds=bounds)
    assert sorted(r[0] for r in items.select("pi_product_fk").collect()) == [2, 4, 4, 4, 4]


def test_bucketed_line_items_are_not_shuffled_for_the_flags(spark):
    """Deployment note in README: with trans_item bucketed on the transaction
    key, the line stream joins the flags without being shuffled."""
    from conftest import SF_SMALL
    from rewardseg.params import TEST_PARAMS
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    derived = derive_sources(spark, SF_SMALL, TEST_PARAMS)
    path = tempfile.mkdtemp(prefix="rewardseg-bucket-") + "/trans_item"
    (derived["trans_item"].write.option("path", path).bucketBy(int(parts), "pi_trans_fk")
     .saveAsTable("bucketed_trans_item"))
    builders = {n: (lambda n=n: derived[n]) for n in derived}
    builders["trans_item"] = lambda: spark.table("bucketed_trans_item")
    plan = _plan(Run(Sources(builders), TEST_PARAMS).lines())
    shuffles = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(pi_trans_fk" in ln]
    assert len(shuffles) == 1   # the flags side only
    spark.sql("DROP TABLE bucketed_trans_item")


def test_online_links_use_the_sweep_not_a_range_join(run_check):
    from rewardseg.operators import loyalty
    plan = _plan(loyalty.online_links(run_check.src, run_check.p))
    assert re.search(r"Window \[sum\(delta", plan)
    assert "BroadcastNestedLoopJoin" not in plan
    joins = [ln for ln in plan.splitlines() if "Join" in ln]
    assert not any("card_link_datetime" in ln or "card_unlink_datetime" in ln for ln in joins)


def test_product_side_is_read_once(spark):
    """With unique keys the item star reads the product table once."""
    from conftest import SF_CHECK
    from rewardseg.plans.registry import make_run
    text = _plan(make_run(spark, SF_CHECK).items)
    scans = [ln for ln in text.splitlines() if "FileScan parquet" in ln and "p_partkey" in ln and "p_size" in ln]
    assert len(scans) == 1, scans


def test_hot_account_is_split_in_the_snapshot_join(spark):
    """Half of the links on one account: the one join on the account splits it."""
    from rewardseg import fixed_values as fv
    from rewardseg.plans.pipeline import snapshot
    from rewardseg.sources.staging import Staging
    staging = Staging(spark)
    account = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    linked = staging.write(spark.range(400_000).select(
        F.col("id").alias("pi_entity_fk"), account.cast("bigint").alias("account_number"), F.lit(1).alias("current_value_score"),
        *[F.lit(1).alias(b) for b in fv.BAND_COLUMNS], F.lit(1).cast("decimal(18,2)").alias("total_spend")).repartition(12), "links")
    accounts = staging.write(spark.range(5000).select(
        F.col("id").alias("account_number"), F.lit("S").alias("segment"), F.lit("B").alias("age_band"), F.lit("F").alias("gender"),
        F.lit("R").alias("region"), F.lit("A").alias("acorn_category"), F.lit(1).cast("bigint").alias("points_balance")), "accounts")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = snapshot(accounts, linked, RunParams(as_of=dt.date(2000, 12, 31), start_year=1996))
        assert out.count() == 400_000
        out.write.format("noop").mode("overwrite").save()
        rows = out.groupBy().count()
        rows.collect()
        assert "skew=true" in _plan(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        staging.remove()


def test_online_orders_are_evaluated_once(spark):
    """A query of one spend step reads its online orders from the run's folder, twice; their outer joins are not in its plan."""
    from conftest import SF_SMALL
    from rewardseg.plans.registry import QUERIES
    for name in ("entity_spend", "category_spend", "flag_loyalty_online", "online_loyalty"):
        text = _plan(QUERIES[name](spark, SF_SMALL))
        assert "res_datetime" not in text and "_jk_null" not in text, name
        assert len([ln for ln in text.splitlines() if "FileScan parquet [pi_trans_pk" in ln or "FileScan parquet [order_date" in ln]) >= 1, name


def test_bucketed_lines_and_tenders_are_not_shuffled(spark):
    """Line items and tenders bucketed on the transaction: neither is shuffled for the flags or the sums per
    transaction, and spend is the same."""
    from conftest import SF_SMALL
    from rewardseg.params import TEST_PARAMS
    from rewardseg.sources.sinks import write_bucketed
    derived = derive_sources(spark, SF_SMALL, TEST_PARAMS)
    root, builders = tempfile.mkdtemp(prefix="rewardseg-bucket-"), {n: (lambda n=n: derived[n]) for n in derived}
    names = {"trans_item": "co_bucketed_item", "trans_tender": "co_bucketed_tender"}
    try:
        for source, name in names.items():
            write_bucketed(derived[source], name, "pi_trans_fk", 8, f"{root}/{source}")
            builders[source] = lambda name=name: spark.table(name)
        plain = Run(derived, TEST_PARAMS, staging="shared")
        run = Run(Sources(builders), TEST_PARAMS, staging="shared", bucketed=True)
        lines = _plan(run.lines())
        shuffled = [ln for ln in lines.splitlines() if re.search(r"Exchange hashpartitioning\(pi_trans_[fp]k", ln)]
        assert len(shuffled) == 1, shuffled       # the online links, which come from the orders' accounts
        assert lines.count("co_bucketed_") == 2 and not any("line_total" in ln for ln in shuffled)
        for of in (lambda r: r.entity_spend(), lambda r: r.entity_spend(dedup=True), lambda r: r.category_spend()):
            got, want = of(run), of(plain)
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count()
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_shared_card_ships_its_best_entities_only(spark):
    """A card hash that half of the entities share: each map task passes on at most max_rank rows of it, and the
    result is that of ranking the whole chain."""
    from rewardseg import fixed_values as fv
    from rewardseg.operators import linking
    profile = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("pi_entity_fk"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).cast("int").alias("current_value_score"),
        *[F.lit(1).alias(b) for b in fv.BAND_COLUMNS], (F.col("id") % 90).cast("decimal(18,2)").alias("total_spend"))
    profile = profile.unionByName(profile.where("pi_entity_fk % 50 = 1").withColumn("current_value_score", F.lit(9)))
    cards = (spark.range(4000).select(F.col("id").alias("pi_entity_fk"), F.when(F.col("id") % 2 == 0, "hot").otherwise(
        F.concat(F.lit("h"), F.col("id") % 300)).alias("loyalty_card_hash"))
        .union(spark.range(900).selectExpr("id", "concat('h', id % 70)")).distinct())
    full_card = spark.range(400).selectExpr("id % 210 AS account_number", "if(id % 9 = 0, 'hot', concat('h', id)) AS loyalty_id")
    for k in (1, 3):
        got = linking.rank_through_cards(profile, cards, full_card, k)
        want = linking.link_rank(linking.link_account(profile, linking.entity_accounts(cards, full_card)), k)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count()
    plan = _plan(got)
    limit = next(i for i, ln in enumerate(plan.splitlines()) if "WindowGroupLimit [loyalty_card_hash" in ln and "Partial" in ln)
    assert any("Exchange hashpartitioning(loyalty_card_hash" in ln for ln in plan.splitlines()[:limit])
