import zlib

import numpy as np

from rewardseg.llm import quality
from rewardseg.llm.common import table


def test_dual_coordinate_descent_meets_its_optimality_conditions():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(30, 8, replace=False)) for _ in range(80)]
    y = np.where([r[0] + rng.normal() > 1.0 for r in rows], 1.0, -1.0)
    scale, cost = rng.normal(size=30), np.full(80, 0.5)
    w = quality.dual_coordinate_descent(rows, y, scale, cost, epochs=400)
    x = np.zeros((80, 31))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
    x[:, 30] = 1

    def loss(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v))).sum()
    best = loss(w)
    for _ in range(300):
        assert loss(w + rng.normal(size=31) * 10 ** rng.uniform(-4, 0)) >= best - 1e-3


def test_features_do_not_depend_on_chunks(monkeypatch):
    text = ("Some words WORDS!! words words | é 12 " * 300).encode()
    whole = quality.features(text)
    monkeypatch.setattr(quality, "CHUNK", 1000)
    assert set(whole) <= set(quality.features(text))
    assert len(quality.features(b"")) == 0 and len(quality.features(b" \n")) == 0


def test_repeated_words_are_marked():
    base = (1 << quality.GRAM_BITS) + (1 << quality.SHAPE_BITS)
    assert base + 15 in quality.features(b"on on on on on on")
    assert base + 15 not in quality.features(b"on of on of on of on")


def test_held_out_accuracy(spark):
    SF_CHECK = "/root/testdata/sf0.01"
    rows = quality.op6_quality(spark, SF_CHECK).collect()
    truth = {r.doc_id: r.quality for r in table(spark, SF_CHECK, "labels").collect()}
    assert len(rows) == table(spark, SF_CHECK, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_odd_documents(odd_docs, odd_rows, no_docs, no_labels, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 0), (None, 1, 0), (6, 7, 0), (7, 1, 0), (9, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for known in (labels, no_labels):
        model = quality.train(odd_docs, known)
        scored = quality.score(odd_docs, model, odd_docs.columns, "quality_score").collect()
        assert len(scored) == len(odd_rows) and all(0 <= r.quality_score <= 1 for r in scored)
        assert len({r.quality_score for r in scored if not (r.text or "")}) == 1
        assert len({r.quality_score for r in scored if r.doc_id in (1, 6)}) == 1
    assert quality.score(no_docs, quality.train(no_docs, no_labels), ["doc_id"]).count() == 0
