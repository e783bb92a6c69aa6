"""Entity spend with loyalty flags, eligible customers, spend per category.

Both spend steps read one stream: the line items of the star with their
transaction's flags.  The line rows are compact (entity, category index,
amount, flags) -- the category label is resolved to a small int on the
product-dimension side -- so the one shuffle on the transaction key that
attaches the flags moves little data.  The fan-out the rules get from the
non-distinct online join and from joining the (up to three) eligible rows
of an entity is applied as an exact integer multiplicity, never by
duplicating rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rewardseg import fixed_values as fv
from rewardseg.params import RunParams

SPEND = "decimal(18,2)"
FLAG_COLUMNS = ("loyalty_instore", "loyalty_online", "instore_red")

# Flag combinations (in store, online, in-store redemption) that can be
# eligible: a loyalty use and no in-store redemption.
ELIGIBLE_COMBINATIONS = ((1, 0, 0), (0, 1, 0), (1, 1, 0))


def to_cents(money: Column) -> Column:
    """Exact integer cents of a 2-decimal amount."""
    return (money * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    """Back to ``decimal(18,2)``, exactly."""
    return (cents.cast("decimal(18,0)") / 100).cast(SPEND)


def flagged_lines(items: DataFrame, flags: DataFrame) -> DataFrame:
    """Line items with their transaction's flags and multiplicity; a
    transaction without flag rows gets flags 0 and multiplicity 1.

    Amounts travel as exact integer cents (``bigint``): the sums below then
    run on primitive longs inside generated code instead of wide-decimal
    buffers, and ANSI mode raises on overflow rather than wrapping."""
    j = items.select("pi_trans_fk", "pi_entity_fk", "spend_category",
                     to_cents(F.col("line_total")).alias("cents")).join(flags, "pi_trans_fk", "left")
    return j.select("pi_entity_fk", "spend_category", "cents",
                    *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in FLAG_COLUMNS],
                    F.coalesce(F.col("multiplicity"), F.lit(1)).alias("multiplicity"))


def flagged_bucketed_lines(items: DataFrame, tender: DataFrame, online: DataFrame) -> DataFrame:
    """``flagged_lines`` for line items and tenders stored bucketed on the
    transaction: the two flag sides are joined one after the other on the
    key of the buckets, so neither lines nor tenders are shuffled (a union of
    both sides would lose the tenders' buckets).  The lines of one
    transaction lie in one task, so they are summed per (transaction, entity,
    category) there before the joins."""
    summed = (items.select("pi_trans_fk", "pi_entity_fk", "spend_category", to_cents(F.col("line_total")).alias("cents"))
              .groupBy("pi_trans_fk", "pi_entity_fk", "spend_category").agg(F.sum("cents").alias("cents")))
    j = summed.join(tender, "pi_trans_fk", "left").join(online, "pi_trans_fk", "left")
    return j.select("pi_entity_fk", "spend_category", "cents",
                    *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in FLAG_COLUMNS],
                    F.coalesce("multiplicity", F.lit(1).cast("bigint")).alias("multiplicity"))


def _weighted() -> Column:
    return F.col("cents") * F.col("multiplicity")


def entity_spend(lines: DataFrame) -> DataFrame:
    """Spend per (entity, in-store loyalty, online loyalty, in-store redemption),
    each line counted ``multiplicity`` times as the online join does."""
    return (lines.groupBy("pi_entity_fk", *FLAG_COLUMNS)
            .agg(from_cents(F.sum(_weighted())).alias("spend")))


def is_eligible(instore: Column, online: Column, red: Column, spend: Column) -> Column:
    return ((instore == 1) | (online == 1)) & (spend > 0) & (red == 0)


def eligible_customers(spend: DataFrame) -> DataFrame:
    """Loyalty users (in store or online) with positive spend and no
    in-store redemption; up to three rows per entity (flag combinations)."""
    return spend.where(is_eligible(F.col("loyalty_instore"), F.col("loyalty_online"),
                                   F.col("instore_red"), F.col("spend")))


def category_spend(lines: DataFrame, p: RunParams, dedup: bool = False) -> DataFrame:
    """Spend per category and in total for eligible entities with positive total.

    One aggregation per entity yields the category sums and the entity's
    spend under each eligible flag combination; the number of combinations
    with positive spend is the number of eligible rows the rules join the
    line items to, so the as-written sums are the entity's sums times that
    count.  ``dedup=True`` counts each eligible entity once (semi join).
    """
    cat = F.col("spend_category")
    flags = [F.col(c) for c in FLAG_COLUMNS]
    combos = [F.sum(F.when((flags[0] == a) & (flags[1] == b) & (flags[2] == c), _weighted())
                    .otherwise(F.lit(0))).alias(f"_combo{i}")
              for i, (a, b, c) in enumerate(ELIGIBLE_COMBINATIONS)]
    # the rules join lines to eligible entities on the entity, so a line without one never counts
    known = lines.where(F.col("pi_entity_fk").isNotNull())
    per_entity = known.groupBy("pi_entity_fk").agg(
        *[F.sum(F.when(cat == i, F.col("cents")).otherwise(F.lit(0))).alias(c)
          for i, c in enumerate(fv.SPEND_COLUMNS)],
        F.sum("cents").alias("total_spend"),
        *combos)
    n_rows = sum((F.col(f"_combo{i}") > 0).cast("int") for i in range(len(ELIGIBLE_COMBINATIONS)))
    n = F.lit(1) if dedup else F.col("n_rows")
    return (per_entity.withColumn("n_rows", n_rows).where(F.col("n_rows") > 0)
            .select("pi_entity_fk", F.lit(p.end_date).alias("run_date"),
                    *[from_cents(F.col(c) * n).alias(c) for c in fv.SPEND_COLUMNS],
                    from_cents(F.col("total_spend") * n).alias("total_spend"))
            .where(F.col("total_spend") > 0))
