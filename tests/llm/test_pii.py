import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F
from rewardseg.llm import pii
from rewardseg.llm.common import table

from .conftest import SF

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for kind, pattern, ok in (("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
                              ("card", CARD, lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
                              ("phone", PHONE, lambda m: 9 <= len(digits(m)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if ok(m)]
    return out


def spelled(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest(doc_id, text):
    spans = base_spans(text)
    return (doc_id, *(sum(k == kind for k, _, _ in spans) for kind in pii.KINDS), hashlib.sha256(spelled(spans).encode()).hexdigest())


def check(rows, got):
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((digest(*r) for r in rows), key=key)
    by = {r.doc_id: r.spans for r in got}
    for doc_id, text in rows:
        if doc_id is not None and sum(d == doc_id for d, _ in rows) == 1:
            spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in by[doc_id].split(",") if x)]
            assert set(base_spans(text)) <= set(spans)
            assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), x[1]))


def result(docs):
    found = pii.personal_spans(docs)
    return found.select("doc_id", *[F.size(F.filter("base", pii._is(i))).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
                        F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"), pii.spelled(F.col("spans")).alias("spans")).collect()


ODD = ["a@b.c%x@d.e", "a@b@c.d", "a@b.c.", "x..y@-.-", "@a.b", "a@b", "é@b.c 😀 a@b.cc", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.002.0255.0", "1.2.3", "1.2.3.4x",
       "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111", "4111111111111112", "0000000000000", "12 34 56 78 90 12 34", "+1 (743) 555-3824",
       "+1 2", "+12345678", "+123456789", "+1234567890123456", "++49 30 123456", "+1.......2", "+4 ((((", "a+1 555 123 4567@x.yy", "1.1.1.1@host.com",
       "call +33 1 23 45 67 89, or mail me@host.org; from 10.0.0.1", "9" * 40, "-".join("1" * 30), "1.1.1." * 30 + "1", "a@b." * 20 + "c"]


def test_base_spans_of_odd_texts(spark, odd_docs, odd_rows, make_docs, no_docs):
    rows = [(r[0], r[1]) for r in odd_rows] + [(100 + i, t) for i, t in enumerate(ODD)]
    docs = make_docs([(i, t, "en", "a") for i, t in rows]).repartition(3)
    check(rows, result(docs))
    assert result(no_docs) == []


def test_base_spans_of_random_texts(spark):
    rng = random.Random(8)
    parts = ["1", "22", "255", "256", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "é", "😀", "4111111111111111", "%", "_", "\n", ":", "x@y.zz", "1.2.3.4"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 60)))) for i in range(400)]
    check(rows, result(spark.createDataFrame(rows, "doc_id long, text string")))


def test_very_long_texts(spark):
    rows = [(1, "1 22 333 " * 40_000), (3, "+49 30 1234567, 10.0.0.1; m@n.oo " * 3000), (4, "1." * 50_000), (6, "9" * 9_000),
            (7, "(1)-" * 50_000), (8, "f:" * 100_000), (9, "743-555-3824 +1 743 555 3824 " * 2000), (5, "a@" * 60_000 + "b.cc")]
    check(rows, result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    # quadratic for the patterns as the contract writes them
    far = [(1, "a" * 600_000 + "@b.cc"), (2, "9" * 600_000 + ".1.1")]
    assert [r.spans for r in sorted(result(spark.createDataFrame(far, "doc_id long, text string")))] == ["email:0:600005", ""]


def planted():
    rng = random.Random(11)
    rows = []
    for i in range(300):
        a, b, c = rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)
        user = rng.choice(["anna", "jo.smith", "k_lee", "max99"])
        rows.append((i, rng.choice([f"please call +1 ({a}) {b}-{c} today", f"write an email to {user}@mail{a}.com soon", f"login from 10.{a % 256}.{b % 256}.{c % 256} ok",
                                    f"order no. {a}{b} of page {c}", f"version {a}.{b}.{c} released", "nothing to see here"])))
    rows += [(1000 + i, f"please call {rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)} today") for i in range(40)]
    rows += [(2000 + i, f"write an email to {rng.choice(['anna', 'bob'])} (at) host{i} (dot) org soon") for i in range(40)]
    rows += [(3000 + i, f"see order 20{i:02d}-11-{10 + i % 20} and part 12-34-{10 + i} at 12:30:{10 + i}") for i in range(40)]
    rows += [(4000 + i, f"login from client 2001:db8:85a3:{i:x}:1:8a2e:370:7334 ok") for i in range(20)]
    return rows


def test_method_adds_spans_and_leaves_others(spark):
    rows = planted()
    got = {r.doc_id: r.spans for r in result(spark.createDataFrame(rows, "doc_id long, text string"))}
    text = dict(rows)
    phones = [i for i in got if 1000 <= i < 2000]
    caught = [i for i in phones if any(x.startswith("phone:12:24") for x in got[i].split(","))]
    assert len(caught) >= 0.9 * len(phones)
    mails = [i for i in got if 2000 <= i < 3000]
    assert sum("email:" in got[i] for i in mails) >= 0.9 * len(mails)
    assert sum("ip:" in got[i] for i in got if i >= 4000) >= 18
    assert all(got[i] == "" for i in got if 3000 <= i < 4000 or text[i] == "nothing to see here" or text[i].startswith(("order", "version")))


def test_label_model_finds_reliable_labelers():
    rng = random.Random(2)
    right = [0.95, 0.9, 0.85, 0.6, 0.55, 0.7]
    counts, truth = {}, {}
    for _ in range(4000):
        y = rng.random() < 0.4
        votes = 0
        for i in reversed(range(pii.LABELERS)):
            say = y if rng.random() < right[i] else not y
            votes = votes * 3 + (1 if rng.random() < 0.1 else 2 * say)
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(y)
    model = pii.label_model([(0, v, n) for v, n in counts.items()])
    hits = sum(sum(y == (model[0, v] > 0.5) for y in ys) for v, ys in truth.items())
    # what one could know at best, with the true reliabilities
    odds = {v: math.log(0.4 / 0.6) + sum((v // 3 ** i % 3 - 1) * math.log(r / (1 - r)) for i, r in enumerate(right)) for v in counts}
    best = sum(sum(y == (odds[v] > 0) for y in ys) for v, ys in truth.items())
    majority = sum(sum(y == (sum(v // 3 ** i % 3 - 1 for i in range(pii.LABELERS)) > 0) for y in ys) for v, ys in truth.items())
    assert hits >= best - 0.01 * 4000 and hits > majority


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1500])
def test_running_sums(spark, n):
    values = list(range(3, 3 + n))
    df = spark.createDataFrame([(values,)], "v array<long>")
    got = df.select(pii.running(F.col("v"), F.lit(0).cast("long"), lambda a, b: a + b).alias("s")).first().s
    assert got == [sum(values[:i]) for i in range(n)]


def test_query_equals_brute_force_and_stays_native(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = pii.op13_personal_data(spark, SF)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    check(rows, got.collect())
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
