"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Source targets: weights share ``share`` of all words; a target stops at
``limit`` times its source's words and the excess is shared again by weight
until none is above (water-filling, solved in one pass over the sources
ordered by limit / weight).

Within a source, whole epochs come first: every document is taken as often
as the target holds the whole source.  The rest of the target is filled by
weighted sampling without replacement: a document's key is an exponential
variate divided by its quality weight, the smallest keys come first, and
documents are taken while the running sum of their sizes stays nearer to
the budget with them than without them.

Scale: documents shrink to (doc_id, source, size, key) once, equal ones to
one row with their number.  They are range-partitioned in the order of
(source, key, id, size, text); a task's run of one source is a slot.  The
running sum is one over slot totals and one inside each slot, so no source,
however large and whatever the weights, is ordered in one task, nor are the
rows without an id, which share a key.

Defined cases: null text has size 0; the null source is a source of its own
and comes last; sizes of 0 are taken 0 words (``copies`` still counts
epochs); rows repeated or sharing a doc_id are drawn one by one, and equal
rows share a key, so which of them is taken is the same result; a missing
weight counts as ``DEFAULT_WEIGHT``; an empty table gives no rows; columns
of the same names as the working ones are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rewardseg.llm.common import WORD, fresh_name, stage, table, word_count

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
SEED = 42
SLOT_ROWS = 4000
MOST_SLOTS = 20_000
UNFOLD = 10_000
SALTS = 16
LEAST_WEIGHT, DEFAULT_WEIGHT = 0.25, 0.625


def quality_weights(labels: DataFrame) -> DataFrame:
    """(weight_id, weight): 1 for labelled quality 1, LEAST_WEIGHT for 0."""
    good = F.col("quality").cast("double").between(0, 1)
    return (labels.where(good & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("weight_id"))
            .agg((LEAST_WEIGHT + (1 - LEAST_WEIGHT) * F.avg(F.col("quality").cast("double"))).alias("weight")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target, n_docs, rank) from rows (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # one row per source from here on
    named = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rank", F.row_number().over(named).cast("long"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("most", limit * F.col("source_size").cast("double"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("goal", share * F.sum("source_size").over(everything).cast("double"))
    per = per.withColumn("ratio", F.col("most") / F.col("weight"))
    # in order of ratio: if the water level of the sources not yet full reaches a source's limit, it is full
    by_ratio = Window.orderBy("ratio", "rank")
    full_before = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_from = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("goal") - full_before) / weight_from)
    per = per.withColumn("is_full", F.col("level") >= F.col("ratio"))
    rest = F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(everything)
    held = F.coalesce(F.sum(F.when(F.col("is_full"), F.col("most"))).over(everything), F.lit(0.0))
    target = F.when(F.col("is_full"), F.col("most")).otherwise(F.col("weight") * ((F.col("goal") - held) / rest))
    return per.select("source", "source_size", target.alias("target"), "n_docs", "rank")


def sampling_key(doc_id: Column, weight: Column, seed: int = SEED) -> Column:
    """An exponential variate of rate ``weight`` from a hash of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / weight


def mix(docs: DataFrame, doc_weights: DataFrame | None = None, weights=WEIGHTS, share: float = SHARE,
        limit: float = LIMIT, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, text_key (a hash of the text),
    size, source_size, target, taken, copies."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       word_count(F.col("text").cast("string")).alias("size"),
                       F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    if doc_weights is not None:
        rows = rows.join(doc_weights, rows["doc_id"] == doc_weights["weight_id"], "left").drop("weight_id")
        weight = F.coalesce("weight", F.lit(DEFAULT_WEIGHT))
    else:
        weight = F.lit(1.0)
    rows = stage(rows.select("doc_id", "source", "text_key", "size", sampling_key(F.col("doc_id"), weight, seed).alias("key")), "mix-rows")
    targets = stage(source_targets(rows, weights, share, limit), "mix-targets")
    # equal rows are one row with a number of them; every source's row once per salt: a hot source is spread over the salts
    folded = rows.groupBy("doc_id", "source", "text_key", "size", "key").agg(F.count(F.lit(1)).alias("rows"))
    spread = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = folded.withColumn("salt", F.pmod(F.xxhash64("key", "text_key"), F.lit(SALTS)).cast("int"))
    known = salted.join(spread.withColumnRenamed("source", "of").withColumnRenamed("salt", "s"),
                        F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("s")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    known = known.select("doc_id", "source", "text_key", "rank", "size", "key", "rows", "source_size", "target", epochs.alias("epochs"))
    order = ["key", "doc_id", "size", "text_key"]
    n_docs = targets.agg(F.sum("n_docs")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(math.ceil(n_docs / SLOT_ROWS), MOST_SLOTS))
    # a slot is a task's run of one source in the order of the keys, whatever weights or ids they come from
    known = stage(known.repartitionByRange(parts, "rank", *order).withColumn("slot", F.spark_partition_id()), "mix-slots")
    words = F.col("size") * F.col("rows")
    per_slot = known.groupBy("rank", "slot").agg(F.sum(words).alias("slot_size"))
    earlier = Window.partitionBy("rank").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    per_slot = per_slot.select("rank", "slot", F.coalesce(F.sum("slot_size").over(earlier), F.lit(0)).alias("slot_start"))
    inside = Window.partitionBy("rank", "slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (known.join(per_slot, ["rank", "slot"])
              .withColumn("before", F.col("slot_start") + F.coalesce(F.sum(words).over(inside), F.lit(0))))
    placed = _unfolded(placed)
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    chosen = (F.col("before") + F.col("size") / 2 <= budget) & (budget > 0) & (F.col("epochs") < limit)
    copies = F.col("epochs") + F.when(chosen, 1).otherwise(0)
    return placed.select("doc_id", "source", "text_key", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"),
                         copies.cast("int").alias("copies"))


def _unfolded(placed: DataFrame) -> DataFrame:
    """Each of ``rows`` equal rows again, ``before`` being the words in front
    of it; a large number is dealt over tasks in pieces of UNFOLD rows."""
    few = placed.where(F.col("rows") <= UNFOLD).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    pieces = placed.where(F.col("rows") > UNFOLD).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / UNFOLD))))
    first = F.col("piece") * UNFOLD
    many = pieces.repartition("doc_id", "source", "text_key", "piece").withColumn(
        "turn", F.explode(F.sequence(first, F.least(first + UNFOLD, F.col("rows")) - 1))).drop("piece")
    return few.unionByName(many).withColumn("before", F.col("before") + F.col("turn") * F.col("size")).drop("turn")


def mixed_documents(docs: DataFrame, doc_weights: DataFrame | None = None, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, as often as they are
    taken.  Rows equal in doc_id, source and text stand for one another."""
    taken = mix(docs, doc_weights, **options).groupBy("doc_id", "source", "text_key").agg(
        F.sum("copies").cast("int").alias("mix_copies")).where("mix_copies > 0")
    of_id, of_source, of_text, times, turn = (fresh_name(f"mix_{c}", docs.columns) for c in ("doc_id", "source", "text_key", "copies", "turn"))
    taken = taken.select(F.col("doc_id").alias(of_id), F.col("source").alias(of_source), F.col("text_key").alias(of_text), F.col("mix_copies").alias(times))
    doc_id, source = docs["doc_id"].cast("long"), docs["source"].cast("string")
    same = ((F.xxhash64(docs["text"].cast("string")) == F.col(of_text)) &
            doc_id.eqNullSafe(F.col(of_id)) & source.eqNullSafe(F.col(of_source)))
    first = F.row_number().over(Window.partitionBy(of_text, of_id, of_source).orderBy(of_text))
    return (docs.join(taken, same).withColumn(turn, first).where(F.col(turn) == 1)
            .withColumn(turn, F.explode(F.array_repeat(F.lit(1), F.col(times))))
            .select(*[docs[c] for c in docs.columns]))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_sql(weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = SEED) -> str:
    """The same mix in DuckDB SQL, with one plain running sum per source."""
    cycle = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(weights))
    return f"""WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size FROM documents),
w AS (
  SELECT doc_id AS weight_id, {LEAST_WEIGHT}::DOUBLE + {1 - LEAST_WEIGHT}::DOUBLE * avg(quality::DOUBLE) AS weight
  FROM labels WHERE quality BETWEEN 0 AND 1 AND doc_id IS NOT NULL GROUP BY doc_id),
keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / {float(1 << 52)}::DOUBLE)
           / coalesce(weight, {DEFAULT_WEIGHT}::DOUBLE) AS key
  FROM sized LEFT JOIN w ON weight_id = doc_id),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, {limit}::DOUBLE * sum(size)::BIGINT AS most,
         (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {cycle} END)::DOUBLE AS weight
  FROM sized GROUP BY source),
goal AS (SELECT {share}::DOUBLE * sum(source_size)::DOUBLE AS goal FROM per),
-- a source is full if the level of itself and all sources of a larger ratio reaches its ratio
leveled AS (
  SELECT p.*, most / weight AS ratio,
         (SELECT coalesce(sum(q.most), 0) FROM per q WHERE q.most / q.weight < p.most / p.weight) AS held_before,
         (SELECT sum(q.weight) FROM per q WHERE q.most / q.weight >= p.most / p.weight) AS weight_from
  FROM per p),
filled AS (SELECT l.*, (goal - held_before) / weight_from >= ratio AS is_full, goal FROM leveled l, goal),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN most ELSE weight * ((goal -
           (SELECT coalesce(sum(most), 0) FROM filled WHERE is_full)) / (SELECT sum(weight) FROM filled WHERE NOT is_full)) END AS target
  FROM filled),
placed AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN targets t ON t.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN before + size / 2 <= target - epochs * source_size AND target - epochs * source_size > 0
                                AND epochs < {limit} THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed"""
