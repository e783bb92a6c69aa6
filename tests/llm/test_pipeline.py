import corpus_pipeline
from pyspark.sql import functions as F
from rewardseg.llm import mixing, quality, simhash
from rewardseg.llm.common import stage, table
from rewardseg.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def test_registry_has_every_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, len(QUERIES) + 1))
    import __spark_entry__
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def test_stages_on_the_table(spark):
    docs = table(spark, SF, "documents")
    kept = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(function(spark, docs, SF), name)
        assert docs.columns == before.columns
        kept[name] = {r[0] for r in docs.select("doc_id").collect()}
        assert kept[name] <= {r[0] for r in before.select("doc_id").collect()}
        if name == "near_dedup":
            want = {r.component_id for r in simhash.near_duplicates(before).collect()}
            assert kept[name] == want and docs.count() == len(want)
        if name == "source_mix":
            mixed = mixing.mix(before, mixing.quality_weights(table(spark, SF, "labels")))
            want = {r.doc_id: r.copies for r in mixed.collect() if r.copies}
            assert {r["doc_id"]: r["count"] for r in docs.groupBy("doc_id").count().collect()} == want
    # clean documents stay: of those labelled 1, the two filters reject at most a few
    good = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()}
    assert len(good - kept["quality_classifier"]) <= 0.02 * len(good)
    junk = {r.doc_id for r in table(spark, SF, "labels").where("quality = 0").collect()}
    assert len(junk & kept["quality_classifier"]) <= 0.2 * len(junk)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    per = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in per)
    assert pieces.where("piece = 0").count() == docs.count()


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, function in corpus_pipeline.STAGES:
            before, docs = docs, stage(function(spark, docs, SF), name)
            assert name == "best_fit_packing" or docs.columns == before.columns
            assert before.count() or not docs.count()
