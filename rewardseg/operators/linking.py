"""Part III: link retail entities to loyalty accounts (many-to-many).

The identity chain entity -> identifier -> current card -> card hash ->
loyalty hash -> account is resolved once as a distinct (entity, key)
mapping; profile rows are then attached to it.  Because both sides are
distinct and joined on the entity, the product is already distinct, which
is exactly the SELECT DISTINCT of the rules without a wide final shuffle.
Shared cards and hot accounts skew these joins; AQE's skew-join splitting
handles the hot partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rewardseg import fixed_values as fv
from rewardseg.sources import Sources

LINK_COLUMNS = ("current_value_score", *fv.BAND_COLUMNS, "total_spend")


def entity_cards(src: Sources) -> DataFrame:
    """Distinct (entity, loyalty card hash) through currently linked cards."""
    cust = src["cust_identifier"].select("pi_entity_fk", "pi_account_id_fk")
    hist = (src["card_history"].where(F.col("card_unlink_datetime").isNull())
            .select("pi_myaccount_fk", "pi_loyalty_card_fk"))
    card = src["loyalty_card"]
    mapping = src["card_mapping"]
    return (cust.join(hist, cust.pi_account_id_fk == hist.pi_myaccount_fk, "inner")
            .join(card, hist.pi_loyalty_card_fk == card.pi_loyalty_card_pk, "inner")
            .join(mapping, card.loyalty_card_hashed == mapping.retailer_card_hash, "inner")
            .select("pi_entity_fk", "loyalty_card_hash").distinct())


def entity_accounts(cards: DataFrame, full_card: DataFrame) -> DataFrame:
    """Distinct (entity, loyalty account) through the loyalty id."""
    return (cards.join(full_card, cards.loyalty_card_hash == full_card.loyalty_id, "inner")
            .select("pi_entity_fk", "account_number").distinct())


def link_loyalty(profile: DataFrame, cards: DataFrame) -> DataFrame:
    """Profile rows with every loyalty hash of the entity (personal data:
    never written to a sink).  ``profile`` is the distinct profile without
    gender (``retail_profile(profiling=None, keep_total=True)``)."""
    return (profile.join(cards, "pi_entity_fk", "inner")
            .select("pi_entity_fk", "loyalty_card_hash", *LINK_COLUMNS))


def link_account(profile: DataFrame, accounts: DataFrame) -> DataFrame:
    return (profile.join(accounts, "pi_entity_fk", "inner")
            .select("pi_entity_fk", "account_number", *LINK_COLUMNS))


def link_cardinality(linked: DataFrame) -> DataFrame:
    """How many accounts have 1, 2, ... linked entities.  Two-level count:
    (account, entity) pairs are de-duplicated map-side first, so a hot
    account never gathers its raw rows in one task."""
    per_account = (linked.select("account_number", "pi_entity_fk").distinct()
                   .groupBy("account_number").agg(F.count(F.lit(1)).alias("entities_per_account")))
    return per_account.groupBy("entities_per_account").agg(F.count(F.lit(1)).alias("accounts"))


def link_share(linked: DataFrame) -> DataFrame:
    """Share of the linked entity base with 1, 2 to 9, and 10 or more
    accounts (two-level count, as in ``link_cardinality``)."""
    per_entity = (linked.select("pi_entity_fk", "account_number").distinct()
                  .groupBy("pi_entity_fk").agg(F.count(F.lit(1)).alias("n")))
    kind = F.when(F.col("n") == 1, "1").when(F.col("n") < 10, "2-9").otherwise("10+")
    counts = per_entity.groupBy(kind.alias("accounts_per_entity")).agg(F.count(F.lit(1)).alias("entities"))
    total = counts.agg(F.sum("entities").alias("base"))  # one row
    return counts.join(F.broadcast(total)).select("accounts_per_entity", "entities",
                                                  (F.col("entities") / F.col("base")).alias("share"))


def _best_first() -> list:
    return [F.col("total_spend").desc_nulls_last(), F.col("pi_entity_fk").asc(), F.col("current_value_score").asc_nulls_first()]


def link_rank(linked: DataFrame, max_rank: int = 1) -> DataFrame:
    """Keep the ``max_rank`` best-spending entities per account (ties broken
    by entity key, so the result is deterministic).  The rank filter lets
    Catalyst insert a partial per-group limit before the shuffle, so a hot
    account ships at most ``max_rank`` rows per map task."""
    order = Window.partitionBy("account_number").orderBy(*_best_first())
    return (linked.withColumn("link_rank", F.row_number().over(order))
            .where(F.col("link_rank") <= max_rank))


def rank_through_cards(profile: DataFrame, cards: DataFrame, full_card: DataFrame, max_rank: int = 1) -> DataFrame:
    """``link_rank(link_account(...), max_rank)`` without the whole chain:
    the best entities are kept per card hash before accounts are attached.

    An account's entities are those of its card hashes, so one that is among
    the account's best is among the best of every hash that leads to it.  Per
    hash ``max_rank`` rows stay (the limit is applied before the shuffle, so a
    card that a third of the entities share ships at most ``max_rank`` rows
    per map task), and only these are joined to accounts, made distinct (an
    entity may be reached through several hashes) and ranked."""
    order = Window.partitionBy("loyalty_card_hash").orderBy(*_best_first())
    per_card = (link_loyalty(profile, cards).withColumn("_card_rank", F.row_number().over(order))
                .where(F.col("_card_rank") <= max_rank))
    accounts = full_card.select("account_number", "loyalty_id").distinct()
    linked = (per_card.join(accounts, F.col("loyalty_card_hash") == F.col("loyalty_id"), "inner")
              .select("pi_entity_fk", "account_number", *LINK_COLUMNS).distinct())
    return link_rank(linked, max_rank)


def account_collapse(linked: DataFrame) -> DataFrame:
    """One row per account: entity count, summed spend (each entity once),
    best score and the highest band per category over its entities."""
    per_entity = linked.groupBy("account_number", "pi_entity_fk").agg(
        F.max("total_spend").alias("total_spend"),
        F.max("current_value_score").alias("current_value_score"),
        *[F.max(b).alias(b) for b in fv.BAND_COLUMNS])
    return per_entity.groupBy("account_number").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.sum("total_spend").cast("decimal(18,2)").alias("total_spend"),
        F.max("current_value_score").alias("current_value_score"),
        *[F.max(b).alias(b) for b in fv.BAND_COLUMNS])
