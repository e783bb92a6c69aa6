import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from rewardseg.llm import packing
from rewardseg.llm.tokens import default_tokenizer


def check_plan(histogram, capacity):
    covered, sequences = np.zeros(capacity + 1, np.int64), 0
    for config, n in packing.plan(histogram, capacity):
        assert n > 0 and sum(length * copies for length, copies in config) <= capacity
        for length, copies in config:
            covered[length] += copies * n
        sequences += n
    assert (covered == histogram).all()
    return sequences


def test_plan_covers_any_histogram_near_the_bound():
    rng = np.random.default_rng(1)
    capacity = 256
    for n, draw in ((0, None), (1, None), (30_000, rng.integers(1, 257, 30_000)),
                    (20_000, np.minimum(rng.pareto(1.0, 20_000) * 20 + 1, 256).astype(int)),
                    (12_000, np.full(12_000, 129)), (9_000, np.full(9_000, 256)), (15_000, np.full(15_000, 100))):
        lengths = draw if draw is not None else np.full(n, 17)
        histogram = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
        sequences = check_plan(histogram, capacity)
        assert sequences <= len(packing.best_fit(histogram, capacity)) * 1.005 + 1
    assert check_plan(np.bincount(np.full(12_000, 129), minlength=257).astype(np.int64), capacity) == 12_000
    assert check_plan(np.bincount(np.full(15_000, 100), minlength=257).astype(np.int64), capacity) == 7_500


def test_best_configuration_is_the_knapsack_optimum():
    rng = np.random.default_rng(2)
    for _ in range(20):
        value = np.append(0, rng.random(12))
        best = np.zeros(13)
        for c in range(1, 13):
            best[c] = max([best[c - 1], *[best[c - x] + value[x] for x in range(1, c + 1)]])
        counts = packing.best_configuration(value, 12)
        assert (counts * np.arange(13)).sum() <= 12 and abs((counts * value).sum() - best[12]) < 1e-12


def test_pieces_of_odd_documents(odd_docs, no_docs, odd_rows):
    capacity = 300
    rows = packing.pack(odd_docs, capacity).collect()
    tokenizer = Tokenizer.from_file(default_tokenizer())
    want = defaultdict(int)
    for doc_id, text, *_ in odd_rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack(no_docs, capacity).count() == 0


def test_the_program_is_used_and_bounded(monkeypatch):
    """Small tables reach the program too; no packing is below the dual bound, and the plan is near it."""
    rng = np.random.default_rng(4)
    calls = []
    price = packing.best_configuration
    monkeypatch.setattr(packing, "best_configuration", lambda *a: calls.append(1) or price(*a))
    for n, draw, slack in ((1153, rng.integers(1, 2049, 1153), 0.03), (4000, np.minimum(rng.pareto(1.0, 4000) * 150 + 1, 2048).astype(int), 0.01),
                           (3000, np.full(3000, 1025), 0.0), (6000, rng.choice([700, 701, 1400], 6000), 0.04)):
        histogram = np.bincount(draw, minlength=2049).astype(np.int64)
        calls.clear()
        sequences = check_plan(histogram, 2048)
        assert calls
        bound = packing.lower_bound(histogram, 2048, 40)
        assert (draw.sum() / 2048) - 1e-6 <= bound <= sequences <= bound * (1 + slack) + 1, (n, bound, sequences)
    assert packing.lower_bound(np.bincount([1025] * 50, minlength=2049), 2048) >= 49.9
    # every way to pack a few pieces
    few = np.bincount([5, 5, 4, 3, 3, 2], minlength=11)
    assert packing.lower_bound(few, 10) <= 3 and check_plan(few.astype(np.int64), 10) == 3
