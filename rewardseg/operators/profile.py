"""Retail profile: gender recode, value score of the run month, spend bands."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from rewardseg import fixed_values as fv
from rewardseg.functions import all_bands, gender_code, month_of, spend_band
from rewardseg.params import RunParams


def value_score_month(scores: DataFrame, p: RunParams) -> DataFrame:
    """Distinct (entity, score) scored in the run's month.  Written as a date
    range (not ``year()``/``month()`` equalities) so it reaches the scan."""
    return (scores.where(month_of("run_date", p.month_first, p.month_last))
            .select("entitykey", "current_value_score").distinct())


def spend_bands(cat_spend: DataFrame) -> DataFrame:
    return cat_spend.select("pi_entity_fk", *all_bands())


def technology_band_fixed(cat_spend: DataFrame) -> DataFrame:
    """Technology band with ascending cuts -- a guessed repair of the ladder,
    reported next to the as-written band, never instead of it."""
    fixed = tuple(Decimal(c) for c in fv.TECHNOLOGY_CUTS_FIXED)
    return cat_spend.select(
        "pi_entity_fk", "technology_spend",
        spend_band("technology_spend", fv.cuts("technology")).alias("technology_spend_band"),
        spend_band("technology_spend", fixed).alias("technology_spend_band_fixed"))


PROFILE_COLUMNS = ("pi_entity_fk", "gender", "current_value_score", *fv.BAND_COLUMNS)


def retail_profile(cat_spend: DataFrame, profiling: DataFrame | None, scores: DataFrame, p: RunParams,
                   keep_total: bool = False) -> DataFrame:
    """Category spend -> (left) gender -> (left) month score -> bands, distinct.

    The gender recode is applied and de-duplicated on the profiling side
    before the join (several raw genders can share a code), and the month
    scores are distinct, so the joined rows are already distinct: the
    final DISTINCT of the rules needs no extra shuffle.  An entity with two
    scores in the month keeps two rows (reported by ``profile_duplicates``).
    ``keep_total`` carries the entity's total spend for the linking steps.

    ``profiling=None`` gives the profile without gender, which is what the
    linking steps read (they drop gender): category spend left-joined to the
    month scores is already distinct, and equals the DISTINCT of the full
    profile without its gender column.
    """
    month = value_score_month(scores, p).withColumnRenamed("entitykey", "s_entity")
    j = cat_spend
    cols = [F.col("pi_entity_fk")]
    if profiling is not None:
        genders = (profiling.select(F.col("entitykey").alias("g_entity"),
                                    gender_code("gender").alias("gender_code")).distinct())
        j = j.join(genders, j.pi_entity_fk == genders.g_entity, "left")
        cols.append(F.coalesce(F.col("gender_code"), F.lit(fv.GENDER_OTHER)).alias("gender"))
    j = j.join(month, j.pi_entity_fk == month.s_entity, "left")
    cols += [F.col("current_value_score"), *all_bands()]
    if keep_total:
        cols.append(F.col("total_spend"))
    return j.select(*cols)


def profile_duplicates(profile: DataFrame) -> DataFrame:
    """Entities with more than one profile row (several month scores or
    genders) -- the fan-out the linking steps inherit."""
    return (profile.groupBy("pi_entity_fk").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))
