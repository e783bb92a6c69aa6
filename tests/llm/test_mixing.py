import math

from rewardseg.llm import mixing


def water_fill(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    """Targets by resharing the excess until no source is above its limit."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= limit * sizes[s]}
        for s in full or open_:
            target[s] = limit * sizes[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    return target


def check(rows, docs, weights=None):
    sizes = {}
    for r in docs:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").replace("\t", " ").replace("\n", " ").split())
    target = water_fill(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
        if sizes[s]:
            epochs = math.floor(target[s] / sizes[s] + 1e-12)
            assert all(r.copies in (epochs, epochs + 1) for r in rows if r.source == s)
    assert len(rows) == len(docs)


def test_odd_documents(odd_docs, odd_rows, no_docs, no_labels, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 0), (None, 1, 0), (6, 7, 0)], "doc_id long, quality int, toxic int")
    weights = mixing.quality_weights(labels)
    assert dict(weights.collect()) == {1: 0.625, 5: 0.25}
    rows = mixing.mix(odd_docs, weights).collect()
    check(rows, odd_rows)
    again = mixing.mix(odd_docs.repartition(5), weights).collect()
    key = lambda r: str(tuple(r))
    assert sorted(rows, key=key) == sorted(again, key=key)
    assert mixing.mix(no_docs, mixing.quality_weights(no_labels)).count() == 0


def test_hot_source_over_many_slots(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_ROWS", 20)
    docs = [(i, "w " * (1 + i * 7 % 23), "en", "hot" if i % 3 else f"s{i % 11}") for i in range(900)]
    rows = mixing.mix(make_docs(docs)).collect()
    check(rows, docs)
    # the documents taken once more are those of the smallest keys
    hot = [r for r in rows if r.source == "hot"]
    assert 0 < sum(r.copies for r in hot)


def test_rows_of_the_mix(odd_docs, make_docs, odd_rows, no_docs):
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    want = {}
    for r in mixing.mix(odd_docs).collect():
        if r.copies:
            want[r.doc_id, r.source, r.text_key] = want.get((r.doc_id, r.source, r.text_key), 0) + r.copies
    from pyspark.sql import functions as F
    got = mixed.groupBy("doc_id", "source", F.xxhash64("text").alias("k")).count().collect()
    assert {(r["doc_id"], r["source"], r["k"]): r["count"] for r in got} == want
    assert mixing.mixed_documents(no_docs).count() == 0


def test_better_documents_come_first(make_docs, spark):
    docs = [(i, "five words are in here", "en", "x" if i < 600 else "y") for i in range(1200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1200)], "doc_id long, quality int, toxic int")
    rows = mixing.mix(make_docs(docs), mixing.quality_weights(labels), weights=(1, 1), share=0.5).collect()
    good = sum(r.copies for r in rows if r.doc_id % 2)
    assert good > 1.5 * sum(r.copies for r in rows if not r.doc_id % 2)


def test_low_weights_and_missing_ids_spread_over_slots(spark, no_labels):
    """Documents of a low weight, and rows without an id (one key), are cut into slots like any other."""
    from pyspark.sql import functions as F
    docs = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("s").alias("source"))
    labels = docs.where("doc_id is not null").select("doc_id", F.lit(0).alias("quality"))
    seen = []
    original = mixing.stage

    def keep(df, name):
        seen.append((name, original(df, name)))
        return seen[-1][1]
    mixing.stage = keep
    try:
        rows = mixing.mix(docs, mixing.quality_weights(labels)).collect()
    finally:
        mixing.stage = original
    slots = dict(seen)["mix-slots"].groupBy("rank", "slot").count().collect()
    assert len(slots) >= 8 and max(r["count"] for r in slots) < 3 * 30_000 / 8
    assert len(rows) == 30_000 and abs(sum(r.taken for r in rows) - rows[0].target) <= 2


def test_many_equal_rows(spark, monkeypatch, make_docs):
    monkeypatch.setattr(mixing, "UNFOLD", 7)
    docs = [(None, "the same text", "en", "a")] * 100 + [(5, "the same text", "en", "a")] * 50 + [(i, "w " * (i % 5), "en", "b") for i in range(60)]
    rows = mixing.mix(make_docs(docs)).collect()
    check(rows, docs)
    assert sum(r.doc_id is None for r in rows) == 100 and sum(r.doc_id == 5 and r.source == "a" for r in rows) == 50


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "x", 1, 2), (2, "c d", "s", "y", 3, 4)],
                                 "doc_id long, text string, source string, mix_doc_id string, mix_copies int, mix_turn int")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and {r.mix_doc_id for r in mixed.collect()} <= {"x", "y"} and mixed.count()
