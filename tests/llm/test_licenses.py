import numpy as np

from rewardseg.llm import licenses


def words(text):
    return licenses.words_of(np.frombuffer(text.encode(), np.uint8))[0]


def local_alignment(a, b):
    """Matched words of the best local alignment, without a band."""
    best, table = (0, 0), {}
    for i in range(len(a)):
        for j in range(len(b)):
            s, m = table.get((i - 1, j - 1), (0, 0))
            options = [(0, 0), (s + 2, m + 1) if a[i] == b[j] else (s - 1, m)]
            options += [(t[0] - 1, t[1]) for t in (table.get((i - 1, j), (0, 0)), table.get((i, j - 1), (0, 0)))]
            table[i, j] = max(options)
            best = max(best, table[i, j])
    return best[1]


def test_words_and_winnowing():
    assert (words("Ab, c-d") == words("aB c D")).all() and len(words("")) == 0
    text = words(" ".join(f"w{i}" for i in range(60)))
    at, _ = licenses.winnow(text, np.zeros(60, np.int64))
    assert np.diff(at).max() <= licenses.WINDOW and at[0] == 0 and at[-1] >= 56
    at, gram = licenses.winnow(np.concatenate([text[:5], text[:5]]), np.repeat([0, 1], 5))
    assert set(gram[at < 5]) == set(gram[at >= 5]) and all(p % 5 <= 2 for p in at)


def test_banded_alignment_equals_the_full_one_near_the_diagonal():
    rng = np.random.default_rng(4)
    for _ in range(40):
        template = rng.integers(0, 50, 30).astype(np.uint64)
        text = template[(rng.random(30) > 0.1)]
        text = np.where(rng.random(len(text)) < 0.1, 99, text).astype(np.uint64)
        got = licenses.align(template, text, -12, 12)
        assert got[0] == local_alignment(template.tolist(), text.tolist())


MIT = licenses.TEMPLATES[3][1]


def test_exact_edited_and_repeated_notices(make_docs, no_docs, odd_docs):
    changed = MIT.replace("obtaining", "getting").replace("and associated", "or other related").upper()
    texts = [(1, f"Some é words. {MIT}. More words."), (2, f"x {changed} y"), (3, "Released under the MIT License. " * 3),
             (4, "Licensed under CC BY-NC 4.0.\nText. Licensed under the Apache License, Version 2.0."),
             (5, "the license of the version under the public"), (6, None), (7, ""), (None, "Released under the mit license"),
             (8, "Licensed under the Apache"), (9, "word " * 50_000 + "This work is licensed under the GNU General Public License, version 3.")]
    docs = make_docs([(i, t, "en", "a") for i, t in texts])
    rows = licenses.scan(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        text = dict(texts)[r.doc_id]
        assert text[r.start:r.end] == r.span and licenses.MIN_COVERAGE <= r.coverage <= 1
    assert {k: sorted(r.license for r in v) for k, v in by.items()} == {
        1: ["MIT"], 2: ["MIT"], 3: ["MIT"] * 3, 4: ["Apache-2.0", "CC-BY-NC-4.0"], None: ["MIT"], 9: ["GPL-3.0-only"]}
    assert by[1][0].span == MIT.rstrip() and by[1][0].coverage == 1.0 and 0.75 <= by[2][0].coverage < 1
    many = make_docs([(1, "Released under the MIT License. some words between. " * 300, "en", "a")])
    assert licenses.scan(many).count() == 300
    assert licenses.scan(no_docs).count() == 0 and licenses.scan(odd_docs).count() == 0
    assert licenses.scan(docs, templates=()).count() == 0


def test_all_notices_of_the_table_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    lines = {"Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0", "Released under the MIT License": "MIT",
             "Licensed under the Apache License, Version 2.0": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3": "GPL-3.0-only"}
    want = {(d.doc_id, name) for d in docs for line, name in lines.items() if line in d.text}
    assert {(r.doc_id, r.license) for r in licenses.op9_licenses(spark, sf).collect()} == want and want
