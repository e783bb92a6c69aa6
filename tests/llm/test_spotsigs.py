import functools
import hashlib
import itertools
import re

from pyspark.sql import functions as F

from rewardseg.llm import spotsigs

ANCHORS = set(spotsigs.ANCHORS)


@functools.cache
def chains(text):
    """The signatures of a text as tuples, by loops."""
    words = re.findall(r"[^\W_]+", (text or "").lower())
    found, i = set(), 0
    while i < len(words):
        if words[i] in ANCHORS:
            j = i
            while j < len(words) and words[j] in ANCHORS:
                j += 1
            after = list(itertools.islice((w for w in words[j:j + 500] if w not in ANCHORS), spotsigs.CHAIN))
            if len(after) == spotsigs.CHAIN:
                found.add((tuple(words[i:j]), *after))
            i = j
        else:
            i += 1
    return frozenset(found or {tuple(words)})


def jaccard(a, b):
    return len(a & b) / len(a | b)


def edited(own, after):
    half = len(own) // 2
    return own[:len(own) - half] + after[:half]


def test_odd_documents_equal_brute_force(odd_docs, odd_rows, no_docs, spark):
    rows = [(r[0], r[1] or "") for r in odd_rows]
    got = spotsigs.with_next(odd_docs).select(
        "doc_id", "text", "next_text", F.size("sigs").alias("n"), spotsigs.likeness(F.col("sigs"), F.col("next_sigs")).alias("near"),
        spotsigs.fingerprint(F.col("sigs")).alias("name")).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for i, t in rows)
    # each row is the next of exactly one other, in descending order
    assert sorted(r.next_text for r in got) == sorted(t for _, t in rows)
    ids = sorted({i for i, _ in rows if i is not None}, reverse=True)
    unique = {i: t for i, t in rows if sum(j == i for j, _ in rows) == 1}
    for r in got:
        if r.doc_id in unique and r.doc_id != ids[-1]:
            follows = ids[ids.index(r.doc_id) + 1]
            if follows in unique:
                assert r.next_text == unique[follows]
        assert r.n == len(chains(r.text)) or not r.text.isascii()
        assert abs(r.near - jaccard(chains(r.text), chains(r.next_text))) < 1e-12
    for a in got:
        for b in got:
            assert a.text != b.text or a.name == b.name
            assert (a.name == b.name) == (chains(a.text) == chains(b.text))
    assert spotsigs.with_next(no_docs).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in spotsigs.op7_spotsigs(spark, sf).collect()}
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    assert len(got) == len(docs)
    for (doc_id, text), (_, after) in zip(docs, [*docs[1:], docs[0]]):
        change = edited(text, after)
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(change.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(chains(text), chains(change))) < 1e-12
        assert abs(r.near_next - jaccard(chains(text), chains(after))) < 1e-12
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)


def test_a_single_row_is_its_own_next(make_docs):
    row = spotsigs.with_next(make_docs([(5, "the cat sat", None, None)])).first()
    assert row.text == row.next_text == "the cat sat"


def test_repeated_anchors_do_not_overflow(make_docs):
    docs = make_docs([(1, "the " * 60_000 + "cat sat", None, None), (2, "word " * 60_000, None, None)])
    assert {r.n for r in spotsigs.with_next(docs).select(F.size("sigs").alias("n")).collect()} == {1}


def test_near_pairs_equal_brute_force(spark):
    import random
    rng = random.Random(3)
    sets = [sorted(rng.sample(range(60), rng.randint(1, 40))) for _ in range(60)]
    sets += [sorted(set(s) - {s[0]} | {rng.randrange(60, 70)}) for s in sets if len(s) > 9]
    sets += [sorted({*s, 99}) for s in sets[:40]]
    named = {f"f{i}": s for i, s in enumerate(map(list, dict.fromkeys(map(tuple, sets))))}
    got = {(r.a, r.b): r.likeness for r in spotsigs.near_pairs(spark.createDataFrame(list(named.items()), "fp string, sigs array<long>")).collect()}
    want = {(a, b): jaccard(set(x), set(y)) for a, x in named.items() for b, y in named.items()
            if a < b and jaccard(set(x), set(y)) >= 0.8}
    assert got == want and len(want) > 20


def test_other_languages_and_marks(make_docs):
    polish = ("Wczoraj wieczorem dzieci poszły nad rzekę, gdzie rybacy naprawiali swoje stare łodzie i śpiewali piosenki o "
              "dalekich morzach, których nikt już nie pamiętał").split()
    changed = [*polish[:-1], "zapomniał"]
    code = "x1 = f(y2); return z3 + w4; if q5 > r6: print(s7); del_ t8 = u9"
    texts = [" ".join(polish), " ".join(changed), code, code.replace("s7", "s70"), "!!! ???", "*** ---", "", " \t\n ",
             "日本語。今日は天気。明日は雨。昨日は雪。", "日本語。今日は天気。明日は雨。昨日は風。"]
    rows = {r.doc_id: r for r in spotsigs.with_next(make_docs([(i, t, None, None) for i, t in enumerate(texts)])).select(
        "doc_id", spotsigs.likeness(F.col("sigs"), F.col("next_sigs")).alias("near"),
        spotsigs.fingerprint(F.col("sigs")).alias("name")).collect()}
    assert rows[1].near > 0.8 and rows[3].near > 0.6 and rows[9].near > 0.3   # each with the one before it
    assert len({rows[i].name for i in (4, 5, 6)}) == 3 and rows[6].name == rows[7].name


def test_shared_and_missing_ids_are_cut(spark):
    """A third of the rows without an id and a third under one: more shards than one hold them, and the order is the same."""
    rows = [(None, f"without an id {i}") for i in range(200)] + [(50, f"under one id {i}") for i in range(200)] + [
        (i, f"the text of {i}") for i in range(100) if i != 50] + [(50, "under one id 7")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = spotsigs.with_next(docs).select("doc_id", "text", "next_text").collect()
    hashes = dict(spark.createDataFrame([(t,) for t in {t for _, t in rows}], "text string").select("text", F.xxhash64("text")).collect())
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]], r[1]))
    want = [(*r, after[1]) for r, after in zip(order, [*order[1:], order[0]])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    numbered = docs.select("doc_id", spotsigs._shard_number(docs, 8, [20, 40, 60, 80]).alias("s"))
    assert numbered.where("doc_id is null").select("s").distinct().count() > 2
    assert numbered.where("doc_id = 50").select("s").distinct().count() > 2
    names = spotsigs._names(spark, 37)
    taken = spark.createDataFrame([(n,) for n in names], "id long").select(F.pmod(F.hash("id"), F.lit(37)).alias("p")).distinct().count()
    assert taken == 37
