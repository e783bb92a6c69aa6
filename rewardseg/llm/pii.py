"""Personal data by weak supervision: labelers vote, EM weighs them, a span
classifier decides.

Base spans.  Four patterns (e-mail, IP address, payment card, phone), each
leftmost and non-overlapping, checked by octet size, Luhn sum and number of
digits.  They are always returned.

Added spans.  Wider patterns find candidates that the base ones leave out
(``name (at) host (dot) org``, IPv6, cards and phones written with other
separators).  Six labelers vote on every candidate, base matches included:
its form, its checksum or range, gazetteers (top-level domains, calling
codes, card issuers, reserved addresses), words of the context for it and
against it, and its edges.  The votes are summed to counts per pattern of
votes; expectation-maximisation on these counts estimates per kind how
often it is personal data and what each labeler says when it is and when
it is not.  The posteriors are soft labels of the final classifier, a
log-linear one over the span's shape, length, separators, edges and the
word before it, trained on all candidates.  What both it and the label
model hold to be personal data, and no base span touches, is added.

Positions.  ``split`` and ``regexp_extract_all`` with one pattern give the
text between matches and the matches; positions are running sums of their
lengths, in code points.  The patterns are written with possessive
repetition and look-behind, so that each is linear in the text and none
recurses per repetition; the matches are the same.

Scale.  Texts are read once and only spans are kept.  There is no shuffle
of texts; the votes and feature sums are combined map-side to tables whose
size is bounded by the number of vote patterns (4 x 3^6) and of feature
buckets (4 x 5 x 256), which is all that reaches the driver.

Defined cases: a null text is an empty one and has no spans; every row is
one row of the result, repeated rows and null doc_ids too; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rewardseg.llm.common import stage, table

KINDS = ("email", "ip", "card", "phone")
# the contract's patterns; a run of characters is entered at its start, or where the last match ended
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# wider patterns for candidates
LOOSE_EMAIL = (r"(?i)(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?: ?[\[({]at[\])}] ?| at |@)[A-Za-z0-9-]++"
               r"(?:(?: ?[\[({]dot[\])}] ?| dot |\.)[A-Za-z0-9-]++)++")
LOOSE_NUMBER = (r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
                r"|(?<![0-9A-Za-z])[0-9]{4}(?:[ ./_-]{1,3}[0-9]{3,6}){2,4}(?![0-9A-Za-z])"
                r"|(?<![0-9A-Za-z+.(-])\(?[0-9]{2,5}\)?(?:[ ./-]{1,2}[0-9]{2,4}){2,4}(?![0-9A-Za-z])")
# words of the context, English, French, German and Spanish
FOR = {
    "email": r"\b(?:e-?mail|mail|contact|contacto|courriel|correo|kontakt|write|adresse)\b",
    "ip": r"\b(?:ip|ipv6|host|client|server|address|adresse|login|servidor|serveur)\b",
    "card": r"\b(?:card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta|payment)\b",
    "phone": r"\b(?:phone|tel|telephone|téléphone|teléfono|telefon|call|mobile|handy|fax|portable|móvil|dial|whatsapp)\b",
}
AGAINST = r"\b(?:isbn|issn|doi|version|release|order|invoice|ref|serial|sku|part|article|rev|build|bestellung|rechnung|facture|pedido|date|page|pages)\b"
TOP_LEVEL = r"(?i)(?:\.|dot[\])} ]+)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at|be|us|ca|br|mx|ar|jp|cn|in|au)$"
CALLING = r"^(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69][0-9]|3[578][0-9]|42[013]|50[0-9]|59[0-9]|67[0-9]|68[0-9]|69[0-2]|85[0-6]|88[06]|96[0-8]|97[0-7]|99[2-8])"
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|35|6011|6[45]|62)"
ROUTED = r"(?i)^(?:[23][0-9a-f]{3}|fe80|f[cd][0-9a-f]{2}):"
RESERVED = r"^(?:0|255)\.|^(?:22[4-9]|23[0-9])\."
LABELERS = 6
SLOTS = 5
BUCKETS = 256
CONTEXT = 48
MIN_POSTERIOR = 0.99     # of the label model: three labelers more for than against
MIN_SCORE = 0.9          # of the classifier
EM_ROUNDS = 60
PRIOR_RIGHT, PRIOR_WRONG = 8, 2
MOST_RIGHT = 0.9         # labelers are not independent: none counts for more
SMOOTHING = 8.0
_CHUNK = 256


# -- positions ------------------------------------------------------------------

def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, zero: Column, step) -> Column:
    """For each element of an array, ``step`` folded over those before it.
    In chunks, as appending to an array copies it."""
    def fold(array, start):
        empty = F.slice(F.array(zero), 1, 0)
        return F.aggregate(array, F.struct(start.alias("at"), empty.alias("out")), lambda s, x: F.struct(
            step(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))

    def of_chunks(chunks):
        ends = F.transform(chunks, lambda c: F.aggregate(c, zero, step))
        return F.flatten(F.zip_with(chunks, fold(ends, zero)["out"], lambda c, start: fold(c, start)["out"]))
    return _let(values, lambda a: _let(F.transform(F.sequence(
        F.lit(0), F.floor(F.greatest(F.size(a) - 1, F.lit(0)) / F.lit(_CHUNK)).cast("int")), lambda c: F.slice(a, c * _CHUNK + 1, F.lit(_CHUNK))), of_chunks))


def _found(hits: Column, gaps: Column) -> Column:
    """Array of (start, end, hit, before, after) from the matches of a
    pattern and the texts between them."""
    pairs = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
    starts = running(F.transform(pairs, lambda p: (F.length(p["gap"]) + F.length(p["hit"])).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    placed = F.zip_with(pairs, starts, lambda p, s: F.struct(
        (s + F.length(p["gap"])).alias("start"), (s + F.length(p["gap"]) + F.length(p["hit"])).alias("end"), p["hit"].alias("hit"),
        F.right(p["gap"], F.lit(CONTEXT)).alias("before")))
    return F.zip_with(placed, F.slice(gaps, F.lit(2), F.size(hits)), lambda p, g: F.struct(
        p["start"].alias("start"), p["end"].alias("end"), p["hit"].alias("hit"), p["before"].alias("before"), F.left(g, F.lit(1)).alias("after")))


# -- checks -----------------------------------------------------------------------

def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits has a Luhn sum."""
    def add(total, i):
        d = F.ascii(F.substr(digits, i, F.lit(1))) - 48
        twice = F.when((F.length(digits) - i) % 2 == 1, 2 * d).otherwise(d)
        return total + twice - F.when(twice > 9, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _card(hit: Column) -> Column:
    return _let(_digits(hit), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False)))


def _octets(hit: Column) -> Column:
    def small(part):
        return _let(F.regexp_replace(part, "^0+", ""), lambda z: (F.length(z) < 3) | ((F.length(z) == 3) & (z <= "255")))
    return F.forall(F.split(hit, r"\."), small)


def _holds(kind: str, hit: Column) -> Column:
    """The base check of a match."""
    if kind == "ip":
        return _octets(hit)
    if kind == "card":
        return _card(hit)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


# -- candidates ---------------------------------------------------------------------

def _vote(yes: Column, no: Column | None = None) -> Column:
    """0 against, 1 abstains, 2 for."""
    vote = F.when(yes, 2)
    return vote.otherwise(1) if no is None else vote.when(no, 0).otherwise(1)


def _check(kind: int, hit: Column, digits: Column) -> Column:
    """The labeler of checksums and ranges."""
    if kind == 0:
        return F.when(hit.contains("@") | F.lower(hit).rlike(r"[\[({]at[\])}]|\bdot\b"), 2).otherwise(1)
    if kind == 1:
        colons = F.regexp_count(hit, F.lit(":"))
        return (F.when(~hit.contains(":"), F.when(_octets(hit), 2).otherwise(0))
                .when((colons == 7) | (hit.contains("::") & (colons >= 2) & (F.length(hit) >= 6)), 2).otherwise(0))
    return F.when(_card(hit) if kind == 2 else F.length(digits).between(9, 15), 2).otherwise(0)


def _gazetteer(kind: int, hit: Column, digits: Column) -> Column:
    """The labeler of domains, reserved addresses, issuers and calling codes."""
    if kind == 0:
        return _vote(hit.rlike(TOP_LEVEL), F.lit(True))
    if kind == 1:
        return F.when(hit.contains(":"), _vote(hit.rlike(ROUTED))).otherwise(_vote(~hit.rlike(RESERVED), F.lit(True)))
    if kind == 2:
        return _vote(digits.rlike(ISSUER), F.lit(True))
    return _vote(hit.rlike(CALLING) | (F.length(digits) == 10) & digits.rlike("^[2-9]") | digits.rlike("^0[1-9]"),
                 hit.startswith("+") | digits.rlike("^1?[01]"))


def _by_kind(kind: int | Column, kinds, of) -> Column:
    if isinstance(kind, int):
        return of(kind)
    out = of(kinds[-1])
    for k in reversed(kinds[:-1]):
        out = F.when(kind == k, of(k)).otherwise(out)
    return out


def _candidate(c: Column, kind: int | Column, form: Column, kinds=(1, 2, 3)) -> Column:
    """(kind, start, end, votes as a number of LABELERS base-3 digits, feature
    buckets) of a match; its kind is known or one of ``kinds``."""
    hit, digits = c["hit"], _digits(c["hit"])
    check = _by_kind(kind, kinds, lambda k: _check(k, hit, digits))
    gazetteer = _by_kind(kind, kinds, lambda k: _gazetteer(k, hit, digits))
    before = F.lower(c["before"])
    cue = _by_kind(kind, kinds, lambda k: before.rlike(FOR[KINDS[k]]))
    against = F.when(before.rlike(AGAINST), 0).otherwise(1)
    last, first = F.right(c["before"], F.lit(1)), c["after"]
    inside = last.rlike("[A-Za-z0-9]$") | first.rlike("^[A-Za-z0-9]")
    same = (F.length(digits) > 6) & digits.rlike(r"^([0-9])\1*$")
    edges = F.when(inside | same, 0).otherwise(1)
    votes = F.lit(0)
    for vote in (form, check, gazetteer, _vote(cue), against, edges):
        votes = votes * 3 + vote
    shape = F.regexp_replace(F.regexp_replace(F.left(hit, F.lit(40)), "[0-9]", "9"), "[A-Za-z]+", "a")
    edge = lambda x: F.when(x == "", 0).when(x.rlike(r"^\s"), 1).when(x.rlike("^[A-Za-z0-9]"), 2).otherwise(3)
    separators = F.lit(0)
    for i, mark in enumerate((" ", "-", ".", "(", "@", ":", "/", "+")):
        separators = separators + F.when(hit.contains(mark), 1 << i).otherwise(0)
    bucket = lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")
    features = F.array(bucket(shape), F.least(F.length(hit), F.lit(BUCKETS - 1)), separators, edge(last) * 4 + edge(first),
                       bucket(F.regexp_extract(before, r"(\S{1,24})\s*$", 1)))
    return F.struct((F.lit(kind) if isinstance(kind, int) else kind).cast("int").alias("kind"), c["start"].alias("start"), c["end"].alias("end"), votes.cast("int").alias("votes"), features.alias("features"))


_CANDIDATE = "array<struct<kind:int,start:bigint,end:bigint,votes:int,features:array<int>>>"


def _checked(kind: str):
    return lambda c: F.struct(*[c[x].alias(x) for x in ("start", "end", "hit", "before", "after")], _holds(kind, c["hit"]).alias("ok"))


def _span(kind: int):
    return lambda c: F.struct(F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"))


def _judged(kind: int):
    return lambda c: _candidate(c, kind, F.when(c["ok"], 2).otherwise(0))


def _is(kind: int):
    return lambda s: s["kind"] == kind


def span_rows(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the base spans (kind, start, end), the matches that
    train the classifier (``seen``) and those that it may add (``open``)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    patterns = {**BASE, "words": LOOSE_EMAIL, "numbers": LOOSE_NUMBER}
    # most texts lack what a pattern needs; these are left to one look
    needs = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+"), "words": F.col("text").rlike(r"(?i)[\[({ ]at[\])} ]")}
    digit = F.col("text").rlike("[0-9]")
    for name, pattern in patterns.items():
        need = needs.get(name, digit if name != "numbers" else F.col("text").rlike(r"[0-9A-Fa-f:]:|[0-9]"))
        rows = rows.withColumns({f"{name}_hits": F.when(need, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))),
                                 f"{name}_gaps": F.when(need, F.split("text", pattern, -1))})
    none = F.array().cast("array<string>")
    rows = rows.select("doc_id", *[F.coalesce(f"{n}_{x}", none).alias(f"{n}_{x}") for n in patterns for x in ("hits", "gaps")])
    rows = rows.select("doc_id", *[_found(F.col(f"{n}_hits"), F.col(f"{n}_gaps")).alias(n) for n in patterns])
    rows = rows.select("doc_id", *[F.transform(F.col(k), _checked(k)).alias(k) for k in KINDS], "words", "numbers")
    base = F.concat(*[F.transform(F.filter(F.col(k), lambda c: c["ok"]), _span(i)) for i, k in enumerate(KINDS)])
    seen = F.concat(*[F.transform(F.filter(F.col(k), lambda c: c["ok"] | (F.length(_digits(c["hit"])) >= 9)) if k == "card" else F.col(k),
                                  _judged(i)) for i, k in enumerate(KINDS)])
    number_kind = lambda c: F.when(c["hit"].contains(":"), 1).when(F.length(_digits(c["hit"])) >= 13, 2).otherwise(3)
    opened = F.concat(F.transform("words", lambda c: _candidate(c, 0, F.when(c["hit"].rlike(r"[\[({]"), 2).otherwise(1))),
                      F.transform("numbers", lambda c: _candidate(c, number_kind(c), F.when(F.regexp_count(c["hit"], F.lit(":")) == 7, 2).otherwise(1))))
    rows = rows.select("doc_id", base.alias("base"), seen.cast(_CANDIDATE).alias("seen"), opened.cast(_CANDIDATE).alias("open"))
    return rows.select("doc_id", "base", "seen", _apart(F.col("open"), F.col("base")).cast(_CANDIDATE).alias("open"))


def _apart(opened: Column, base: Column) -> Column:
    """The candidates that overlap no base span and no candidate before
    them: spans in order of their start, with the furthest end of a base
    span or candidate before each and the first base start behind it."""
    mark = lambda c, is_base: F.struct(c["start"].alias("start"), F.lit(0 if is_base else 1).alias("open"), c["end"].alias("end"),
                                       (F.lit(None).cast("struct<kind:int,start:bigint,end:bigint,votes:int,features:array<int>>") if is_base else c).alias("c"))

    def keep(order):
        no = F.lit(None).cast("long")
        ends = running(F.transform(order, lambda s: s["end"]), F.lit(-1).cast("long"), lambda a, b: F.greatest(a, b))
        later = F.reverse(running(F.transform(F.reverse(order), lambda s: F.when(s["open"] == 0, s["start"])), no, lambda a, b: F.least(a, b)))
        judged = F.zip_with(F.zip_with(order, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), later, lambda x, n: F.struct(
            x["s"]["c"].alias("c"), ((x["s"]["open"] == 1) & (x["e"] <= x["s"]["start"]) & (n.isNull() | (n >= x["s"]["end"]))).alias("ok")))
        return F.transform(F.filter(judged, lambda x: x["ok"]), lambda x: x["c"])
    everything = F.sort_array(F.concat(F.transform(base, lambda b: mark(b, True)), F.transform(opened, lambda c: mark(c, False))))
    return F.when(F.size(opened) == 0, opened).otherwise(_let(everything, keep))


# -- label model and classifier -------------------------------------------------------

def label_model(patterns: list[tuple[int, int, int]], rounds: int = EM_ROUNDS) -> dict[tuple[int, int], float]:
    """EM over (kind, votes, count): P(personal data) of every pattern of
    votes, from per kind a share and each labeler's reliability: how often it
    is right when it does not abstain.  ``PRIOR_RIGHT`` and ``PRIOR_WRONG``
    pseudo-votes say that labelers are better than chance."""
    out = {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = [([v // 3 ** i % 3 - 1 for i in range(LABELERS)], n, v) for k, v, n in patterns if k == kind]
        right, share, post, weight = [PRIOR_RIGHT / (PRIOR_RIGHT + PRIOR_WRONG)] * LABELERS, 0.5, [], []
        for _ in range(rounds):
            weight = [math.log(r / (1 - r)) for r in right]
            odds = [math.log(share / (1 - share)) + sum(w * v for w, v in zip(weight, votes)) for votes, _, _ in rows]
            post = [1 / (1 + math.exp(-max(-30.0, min(30.0, o)))) for o in odds]
            says, agrees = [PRIOR_RIGHT + PRIOR_WRONG] * LABELERS, [float(PRIOR_RIGHT)] * LABELERS
            for (votes, n, _), p in zip(rows, post):
                for i, v in enumerate(votes):
                    if v:
                        says[i] += n
                        agrees[i] += n * (p if v > 0 else 1 - p)
            right = [min(MOST_RIGHT, a / s) for a, s in zip(agrees, says)]
            total = sum(n for _, n, _ in rows)
            share = (sum(n * p for (_, n, _), p in zip(rows, post)) + 1) / (total + 2)
        # a common kind does not make up for labelers: the votes alone bound the posterior
        alone = [1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w * v for w, v in zip(weight, votes)))))) for votes, _, _ in rows]
        out |= {(kind, v): min(p, q) for (_, _, v), p, q in zip(rows, post, alone)}
    return out


def _numbers(values: list[float]) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(f"{v:.9g}" for v in values)), ",").cast("array<double>")


def train(rows: DataFrame) -> tuple[list[float], list[float], list[float]]:
    """(posterior by kind and votes, weights by kind, slot and bucket, log
    odds by kind) from all candidates of ``span_rows``."""
    spans = rows.select(F.explode(F.concat("seen", "open")).alias("c")).select("c.kind", "c.votes", "c.features")
    counts = [(r.kind, r.votes, r["count"]) for r in spans.groupBy("kind", "votes").count().collect()]   # at most 4 x 3^6 rows
    model = label_model(counts)
    posterior = [model.get((k, v), 0.0) for k in range(4) for v in range(3 ** LABELERS)]
    soft = F.element_at(_numbers(posterior), F.col("kind") * 3 ** LABELERS + F.col("votes") + 1)
    sums = spans.select("kind", soft.alias("p"), F.posexplode("features").alias("slot", "bucket")).groupBy("kind", "slot", "bucket").agg(
        F.sum("p").alias("p"), F.count(F.lit(1)).alias("n")).collect()                                   # at most 4 x 5 x 256 rows
    totals = [(sum(r.p for r in sums if (r.kind, r.slot) == (k, 0)), sum(r.n for r in sums if (r.kind, r.slot) == (k, 0))) for k in range(4)]
    weights = [0.0] * (4 * SLOTS * BUCKETS)
    for r in sums:
        p, n = totals[r.kind]
        usual = SMOOTHING * r.n / n          # a bucket that one class hardly has weighs as much as its share of all
        weights[(r.kind * SLOTS + r.slot) * BUCKETS + r.bucket] = (math.log((r.p + usual) / (p + SMOOTHING))
                                                                   - math.log((r.n - r.p + usual) / (n - p + SMOOTHING)))
    return posterior, weights, [math.log((p + 1) / (n - p + 1)) for p, n in totals]


def _score(c: Column, weights: Column, shares: Column) -> Column:
    """The classifier's log odds of a candidate."""
    total = F.element_at(shares, c["kind"] + 1)
    for slot in range(SLOTS):
        total = total + F.element_at(weights, (c["kind"] * SLOTS + slot) * BUCKETS + F.element_at(c["features"], slot + 1) + 1)
    return total


def personal_spans(docs: DataFrame, min_posterior: float = MIN_POSTERIOR, min_score: float = MIN_SCORE) -> DataFrame:
    """Per row: doc_id, the base spans and all spans, arrays of (kind number,
    start, end) in order of kind and start."""
    rows = stage(span_rows(docs), "spans")
    posterior, weights, odds = train(rows)
    least = math.log(min_score / (1 - min_score))
    labelled, weight, shares = _numbers(posterior), _numbers(weights), _numbers(odds)
    added = F.transform(F.filter("open", lambda c: (F.element_at(labelled, c["kind"] * 3 ** LABELERS + c["votes"] + 1) >= min_posterior)
                                 & (_score(c, weight, shares) >= least)),
                        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return rows.select("doc_id", F.sort_array("base").alias("base"), F.sort_array(F.concat("base", added)).alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1),
                                                               s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.size(F.filter("base", _is(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
