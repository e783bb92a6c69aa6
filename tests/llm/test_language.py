import itertools
import zlib

import numpy as np

from rewardseg.llm import language
from rewardseg.llm.common import table


def test_words_and_chains():
    words = language.Words(["Ab cd. Ab\nef 12", "", "é", "x1y"])
    assert words.n == 7 and words.text.tolist() == [0, 0, 0, 0, 2, 3, 3]
    assert words.chain_starts.tolist() == [0, 2, 3, 4, 5]
    assert words.word[0] == words.word[2] and len(words.hashes) == 6
    assert language.Words(["AB"]).hashes == language.Words(["ab"]).hashes
    assert language.Words([]).n == 0 and language.Words(["", "1 2"]).n == 0


def test_grams_stay_inside_their_word():
    one, two = language.Words(["abc"]), language.Words(["abc abcd"])
    of, gram = two.grams()
    where = int(np.flatnonzero(two.hashes == one.hashes[0])[0])
    assert sorted(gram[of == where]) == sorted(one.grams()[1]) and len(one.grams()[1]) == 4 + 3 + 2


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    words = language.Words(["aa bb cc dd. ee\nff gg hh ii jj", "kk"])
    model = language.Model(["p", "q", "r"], np.zeros((1 << language.LEXICON_BITS, 3)))
    model.transitions = rng.normal(size=(3, 3))
    emissions = rng.normal(size=(len(words.hashes), 3))
    got, pairs = model.posteriors(emissions, words)
    want, want_pairs = np.zeros((words.n, 3)), np.zeros((3, 3))
    for a, b in zip(words.chain_starts, [*words.chain_starts[1:], words.n]):
        paths = list(itertools.product(range(3), repeat=b - a))
        score = np.array([sum(emissions[words.word[a + t], y] for t, y in enumerate(p)) +
                          sum(model.transitions[x, y] for x, y in zip(p, p[1:])) for p in paths])
        share = np.exp(score - score.max())
        for p, s in zip(paths, share / share.sum()):
            for t, y in enumerate(p):
                want[a + t, y] += s
            for x, y in zip(p, p[1:]):
                want_pairs[x, y] += s
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_code_switched_words_get_their_own_language():
    texts = ["the house is on the hill and the dog sleeps"] * 30 + ["la maison est dans la rue et le chien dort"] * 30
    labels = np.array([0] * 30 + [1] * 30)
    model = language.fit(texts, labels, ["en", "fr"], np.zeros((1 << language.LEXICON_BITS, 2)))
    words = language.Words(["the dog sleeps. le chien dort dans la rue"])
    posterior, _ = model.posteriors(model.emissions(words, words.grams()), words)
    assert posterior.argmax(1).tolist() == [0, 0, 0, 1, 1, 1, 1, 1, 1]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = language.op10_language(spark, sf).collect()
    truth = {r.doc_id: r.lang for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_documents(odd_docs, odd_rows, no_docs, make_docs):
    model = language.train(odd_docs)
    rows = language.predict(odd_docs, model, odd_docs.columns, ("guess", "share")).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.guess in model.languages) if letters else (r.guess, r.share) == ("und", 0.0)
    assert language.predict(no_docs, language.train(no_docs), ["doc_id"]).count() == 0
    unlabelled = make_docs([(3, "some words", None, "a")])
    assert [r.lang_pred for r in language.predict(unlabelled, language.train(unlabelled), ["doc_id"]).collect()] == ["und"]


def _made_up(language_number, rng, words):
    """Text in a language of its own letters pairs."""
    own = [chr(97 + language_number % 26) + chr(97 + language_number // 26 + i) + chr(97 + i) for i in range(12)]
    return " ".join(rng.choice(own) + rng.choice(own) for _ in range(words))


def test_rare_languages_are_learned(make_docs):
    rng = np.random.default_rng(3)
    rows = [(i, _made_up(i % 70, rng, 40), f"l{i % 70:02}", "a") for i in range(70 * 8)]
    rows += [(1000 + i, _made_up(i % 64, rng, 40), f"l{i % 64:02}", "a") for i in range(64 * 2)]
    docs = make_docs(rows)
    model = language.train(docs)
    assert len(model.languages) == 70
    got = language.predict(docs, model, ["doc_id", "lang"]).collect()
    rare = [r for r in got if r.lang >= "l64"]
    assert sum(r.lang_pred == r.lang for r in rare) >= 0.9 * len(rare)


def test_a_language_of_long_texts_is_drawn(make_docs, monkeypatch):
    rng = np.random.default_rng(5)
    length = language.SAMPLE_CHARS // 5
    docs = make_docs([(i, _made_up(i % 3, rng, length if i % 3 == 2 else 60), f"l{i % 3}", "a") for i in range(60)])
    drawn = []
    fit = language.fit
    monkeypatch.setattr(language, "fit", lambda texts, labels, *rest: drawn.append((texts, labels)) or fit(texts, labels, *rest))
    model = language.train(docs)
    (texts, labels), = drawn
    assert set(labels) == {0, 1, 2} and max(map(len, texts)) == language.SAMPLE_CHARS
    got = language.predict(docs, model, ["doc_id", "lang"]).collect()
    assert all(r.lang_pred == r.lang for r in got)
