"""The training-data pipeline: documents to packed token sequences.

Five stages, each a function (spark, docs, sf_dir) -> DataFrame that calls
one operator; its result is written as Parquet and reread as the next one's
docs.  All but the last return the columns of the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rewardseg.llm import language, mixing, packing, quality, simhash
from rewardseg.llm.common import fresh_name, stage, table

MIN_LANGUAGE_SHARE = 0.4     # below it, no language holds the text together
MIN_QUALITY = quality.THRESHOLD


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language: some letters, and one language with
    at least MIN_LANGUAGE_SHARE of the words."""
    pred, share = fresh_name("lang_pred", docs.columns), fresh_name("lang_share", docs.columns)
    labelled = language.predict(docs, language.train(docs), docs.columns, (pred, share))
    return labelled.where((F.col(pred) != "und") & (F.col(share) >= MIN_LANGUAGE_SHARE)).select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose quality score reaches MIN_QUALITY; the model is
    trained on the labelled ones among them."""
    score = fresh_name("quality_score", docs.columns)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, docs.columns, score).where(F.col(score) >= MIN_QUALITY).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.deduplicate(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs, mixing.quality_weights(table(spark, sf_dir, "labels")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# Trained models, XXH64 fingerprints and tokenizers are beyond SQL; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
