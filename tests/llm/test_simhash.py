import random
import re

import numpy as np
import xxhash

from rewardseg.llm import simhash
from rewardseg.llm.graph import components


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_every_pattern_of_three_bits_shares_a_key():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 600).astype(np.uint64)
    for k in (1, 2, 3):
        other = base.copy()
        for i in range(len(other)):
            for bit in rng.choice(64, k, replace=False):
                other[i] ^= np.uint64(1) << np.uint64(bit)
        a, b = (set(zip(*(x.tolist() for x in simhash.fuzzy_keys(v.view(np.int64))))) for v in (base, other))
        assert {row for row, _ in a & b} == set(range(len(base)))


def test_golay_masks_reach_codewords():
    masks, counts = simhash.coset_masks()
    words = np.arange(0, 1 << 23, 4099)
    s = simhash._remainder(words)
    for x in range(6):
        has = counts[s] > x
        assert (simhash._remainder((words ^ masks[s, x])[has]) == 0).all()
    assert (np.bincount(counts)[[1, 6]] == [277, 1771]).all()


def test_links_equal_brute_force(spark):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:60]:
        for k in (1, 2, 3, 4):
            q = p
            for bit in rng.sample(range(64), k):
                q ^= 1 << bit
            prints.add(q)
    prints = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & mask).bit_count() <= 3}


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(501, 560)] + [(7000, 7000), (None, 3)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)] + [(-5, 60), (60, -5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    nodes = sorted({x for e in edges if None not in e and e[0] != e[1] for x in e})
    pairs = {frozenset(e) for e in edges}
    want = groups(len(nodes), lambda i, j: frozenset((nodes[i], nodes[j])) in pairs)
    assert got == {n: nodes[g] for n, g in zip(nodes, want)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_documents_equal_brute_force(odd_docs, no_docs, odd_rows, make_docs):
    copies = [(100 + i, "shared text of a large group of copies " * 3, "en", "a") for i in range(40)]
    edited = [(200 + i, " ".join(["lorem ipsum dolor sit amet consectetur"] * 40 + [f"tail{i}"]), "en", "a") for i in range(12)]
    rows = [*odd_rows, *copies, *edited]
    docs = make_docs(rows)
    prints = [brute_print(r[1]) for r in rows]
    group = groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in set(group)}
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r)
    want = sorted(((r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, group)), key=key)
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=key)
    assert got == want
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len(least)
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(v for v in least.values() if v is not None)
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.deduplicate(no_docs).count() == 0


def spread(rng, centres, each, bits):
    """Signed fingerprints around a few centres."""
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            p = c
            for bit in rng.sample(range(64), rng.randrange(bits + 1)):
                p ^= 1 << bit
            out.add(p - (1 << 64) if p >> 63 else p)
    return sorted(out)


def test_spanning_links_equal_brute_force(spark):
    rng, mask = random.Random(6), (1 << 64) - 1
    prints = spread(rng, 40, 1, 0) + spread(rng, 6, 30, 3) + spread(rng, 3, 60, 5)
    group = groups(len(prints), lambda i, j: ((prints[i] ^ prints[j]) & mask).bit_count() <= 3)
    linked = {i for i, g in enumerate(group) if group.count(g) > 1}
    least = {g: min(p for p, h in zip(prints, group) if h == g) for g in set(group)}
    want = {prints[i]: least[group[i]] for i in linked}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(3)
    for chunk in (3, 20, 2000):  # keys cut into many parts, a few, none
        assert dict(simhash.spanning_links(frame, chunk=chunk).collect()) == want
    for bits in (0, 1, 2):
        group = groups(len(prints), lambda i, j: ((prints[i] ^ prints[j]) & mask).bit_count() <= bits)
        got = simhash.spanning_links(frame, max_bits=bits, chunk=7).groupBy("component").count().collect()
        assert sorted(r["count"] for r in got) == sorted(group.count(g) for g in set(group) if group.count(g) > 1)
    assert simhash.spanning_links(frame.limit(0)).count() == 0


def test_links_of_a_dense_key_are_few():
    rng = random.Random(7)
    fps = np.array(spread(rng, 1, 3000, 2), np.int64)
    a, b = simhash.key_links(np.array([0]), np.array([len(fps)]), fps, 3)
    assert len(a) == len(fps) - 1 and (np.bitwise_count((a ^ b).view(np.uint64)) <= 3).all()
    small = fps[:50]
    a, _ = simhash.key_links(np.array([0]), np.array([50]), small, 3)
    assert len(a) <= 100


def test_clashing_names(spark):
    rows = [(1, "one two three four", "a", 1, 2, "x"), (2, "one two three four", "b", 3, 4, "y"), (3, "another text altogether here", "c", 5, 6, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_doc_id string, keep_turn int, keep_no_id int, keep_text_key string")
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and {r.keep_doc_id for r in kept.collect()} == {"a", "c"}
