"""op6 and op10 from end to end against loops over plain Python numbers.

The training counts, features, scores and posteriors are stated again here;
the two optimisers (dual coordinate descent, gradient steps) have tests of
their own and are used as they are.
"""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from rewardseg.llm import language, quality
from rewardseg.llm.common import table

from .conftest import SF

MIX, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


# -- quality ------------------------------------------------------------------

def byte_class(b):
    if 97 <= b <= 122 or b >= 128:
        return 1
    return 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else 4 if b in b" \t\n\v\f\r" else b


def hashed(symbols, n, bits):
    for i in range(len(symbols) - n + 1):
        key = 0
        for s in symbols[i:i + n]:
            key = (key << 8 | s) & MASK
        yield (key * MIX & MASK) >> (64 - bits)


def features(text):
    raw = (text or "").encode()
    kinds = [byte_class(b) for b in raw]
    kinds = [k for i, k in enumerate(kinds) if not i or k != kinds[i - 1]]
    words = raw.split()
    same = [0, 0, 0] + [int(a == b) for a, b in zip(words, words[1:])]
    grams, shapes = 1 << quality.GRAM_BITS, 1 << quality.SHAPE_BITS
    found = set(hashed(list(raw), 3, quality.GRAM_BITS)) | {grams + h for h in hashed(kinds, 6, quality.SHAPE_BITS)}
    found |= {grams + shapes + 8 * a + 4 * b + 2 * c + d for a, b, c, d in zip(same, same[1:], same[2:], same[3:])}
    return np.array(sorted(found), np.int64)


def test_quality_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    labels = {}
    for r in table(spark, SF, "labels").collect():
        if r.quality in (0, 1):
            labels[r.doc_id] = min(labels.get(r.doc_id, 1), r.quality)
    found = {i: features(t) for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}
    known = [i for i in docs if i in labels and not held[i]]
    counts, totals = [Counter(), Counter()], [0, 0]
    for i in known:
        totals[labels[i]] += 1
        counts[labels[i]].update(found[i].tolist())
    scale = np.array([math.log(((counts[1][f] + 1) / (totals[1] + 2)) / ((counts[0][f] + 1) / (totals[0] + 2)))
                      for f in range(quality.N_FEATURES)])
    # all labelled documents fit the sample; it is read label 0 first, in order of the id's hash
    key = dict(spark.createDataFrame([(i,) for i in known], "i long").select("i", F.xxhash64("i")).collect())
    picked = sorted(known, key=lambda i: (labels[i], key[i]))
    y = np.array([2.0 * labels[i] - 1 for i in picked])
    size = np.sqrt(np.mean([sum(scale[f] ** 2 for f in found[i]) + 1 for i in picked]))
    w = quality.dual_coordinate_descent([found[i] for i in picked], y, scale / size, np.full(len(y), quality.COST))
    weight = scale * w[:-1] / size
    margin = {i: sum(weight[f] for f in found[i]) + w[-1] for i in docs}
    # every class's share of the sample is its share of the labels here
    slope, intercept = quality.logistic_fit(np.array([margin[i] for i in picked]), y, np.ones(len(y)))
    got = quality.op6_quality(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        want = 1 / (1 + math.exp(-max(-35.0, min(35.0, slope * margin[r.doc_id] + intercept))))
        assert r.held_out == held[r.doc_id] and r.score == pytest.approx(want, abs=1e-6)
        assert r.predicted == int(r.score >= 0.3)


# -- language -----------------------------------------------------------------

def chains(text):
    """The chains of a text: lists of lower-cased words."""
    out, word, chain = [], "", []
    for c in (text or "") + "\n":
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
            continue
        if word:
            chain.append(word)
            word = ""
        if c in language.SENTENCE_END and chain:
            out.append(chain)
            chain = []
    return out


def word_hash(word):
    total = 0
    for place, c in enumerate(word):
        value = (ord(c) + 1) * (MIX * (2 * place + 1) & MASK) & MASK
        total += value ^ value >> 29
    return (total & MASK) * MIX & MASK


def grams(word):
    letters = [1, *map(ord, word), 2]
    for n in language.GRAMS:
        for i in range(len(letters) - n + 1):
            key = n
            for x in letters[i:i + n]:
                key = (key * 1_000_003 + x) & MASK
            yield (key * MIX & MASK) >> (64 - language.GRAM_BITS)


def posteriors(chain, emission, transitions):
    """Posterior of every word of a chain by forward-backward in logarithms."""
    k = len(transitions)
    add = lambda xs: max(xs) + math.log(sum(math.exp(x - max(xs)) for x in xs))
    forward = [emission[chain[0]]]
    for w in chain[1:]:
        forward.append([emission[w][j] + add([forward[-1][i] + transitions[i][j] for i in range(k)]) for j in range(k)])
    backward = [[0.0] * k]
    for w in reversed(chain[1:]):
        backward.append([add([transitions[i][j] + emission[w][j] + backward[-1][j] for j in range(k)]) for i in range(k)])
    for f, b in zip(forward, reversed(backward)):
        both = [x + y for x, y in zip(f, b)]
        yield [math.exp(x - add(both)) for x in both]


def test_language_query_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    model = language.train(docs)
    # the lexicon: words of every training document
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in rows}
    languages = sorted({v for i, t, v in rows if v is not None and t is not None and not held[i]})
    assert model.languages == languages
    k, buckets = len(languages), 1 << language.LEXICON_BITS
    n = np.zeros((buckets, k))
    for i, text, v in rows:
        if v is not None and text is not None and not held[i]:
            for chain in chains(text):
                for w in chain:
                    n[word_hash(w) >> (64 - language.LEXICON_BITS), languages.index(v)] += 1
    share = np.log((n + 0.5) / (n.sum(0) + 0.5 * buckets))
    lexicon = np.clip(share - share.mean(1, keepdims=True), -3, 3)
    assert np.allclose(lexicon, model.lexicon)
    emission, transitions = {}, model.transitions.tolist()
    got = {r.doc_id: r for r in language.op10_language(spark, SF).collect()}
    assert len(got) == len(rows)
    for doc_id, text, _ in rows:
        mass, total = [0.0] * k, 0
        for chain in chains(text):
            for w in chain:
                if w not in emission:
                    of = model.weights[list(grams(w))].sum(0) / math.sqrt(len(w) + 2)
                    emission[w] = (of + model.lexicon_weight * lexicon[word_hash(w) >> (64 - language.LEXICON_BITS)]).tolist()
            for p in posteriors(chain, emission, transitions):
                mass = [a + b for a, b in zip(mass, p)]
                total += 1
        r = got[doc_id]
        assert r.held_out == held[doc_id]
        if not total:
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == languages[int(np.argmax(mass))] and r.score == pytest.approx(max(mass) / total, abs=1e-6)
