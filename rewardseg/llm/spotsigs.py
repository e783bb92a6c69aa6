"""Document fingerprints with SpotSigs.

A text is lower-cased and reduced to words (runs of letters and digits).  At
every anchor, a very common word of one of the languages, a signature is
formed: the anchor and the chain of the next ``CHAIN`` content words (words
that are not anchors themselves).  The fingerprint is the set of signatures;
its name is a hash of the sorted set, so equal texts have equal fingerprints,
and the likeness of two documents is the Jaccard coefficient of their sets.
A text without any signature, as one in a language that the anchors are not
of, code or a list, is represented by all its chains of ``CHAIN`` + 1
neighbouring words; a text without a word by those of its runs of other marks.

``near_pairs`` finds all pairs of distinct fingerprints of a likeness of at
least ``threshold``: the sets are partitioned by their length, so that a
set only meets sets of its own or the next partition; within a partition,
two sets that are alike enough share one of their rarest signatures (prefix
filter), and candidates are pruned by length before the sets are compared.

Everything runs on DataFrame functions.

Defined cases: null text is the empty text; texts of spaces alone all
have the same one-signature set; a null doc_id comes last in descending order;
rows sharing a doc_id follow one another by the hash of their text; a single
row is its own next document; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rewardseg.llm.common import table

# The most common function words of English, French, German and Spanish.
ANCHORS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "in", "is", "it", "of", "on", "or",
           "that", "the", "this", "to", "was", "with",
           "au", "avec", "ce", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "ne", "par", "pas",
           "pour", "que", "qui", "sur", "un", "une",
           "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "sich", "und",
           "von", "zu",
           "al", "como", "con", "del", "el", "los", "las", "no", "por", "se", "su", "y")
CHAIN = 2
THRESHOLD = 0.8
MARK = "\u0001"

# anchors in a row behind a content word, then CHAIN content words with anchors between them
_SPOT = f"{MARK}(?=([^ ]*+" + f" [^ {MARK}]++(?:{MARK}[^ ]*+)?" * (CHAIN - 1) + f" [^ {MARK}]++))[^ ]*+"


def signatures(text: Column) -> Column:
    """The sorted set of signature hashes of a text (never empty).

    Content words are written after a space and anchors after a mark, so
    that one pattern without alternatives finds each run of anchors with
    the content words it leads to; the anchors between those are dropped."""
    words = F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " ")
    marked = F.array_join(F.transform(F.split(words, " "), lambda x: F.concat(
        F.when(x.isin(*ANCHORS), F.lit(MARK)).otherwise(F.lit(" ")), x)), "")
    spots = F.regexp_extract_all(marked, F.lit(_SPOT), F.lit(1))

    def chain(x):
        first = F.substring_index(x, " ", 1)
        words_after = [F.substring_index(F.substring_index(F.substring_index(x, " ", k + 1), " ", -1), MARK, 1)
                       for k in range(1, CHAIN + 1)]
        return F.xxhash64(first, *words_after)

    found = F.sort_array(F.array_distinct(F.transform(spots, chain)))
    # bound to a name, so that the set is made once
    return _bound(found, lambda s: F.when(F.size(s) > 0, s).otherwise(all_chains(text)))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is made once (by a one-element transform)."""
    return F.get(F.transform(F.array(value), use), 0)


def all_chains(text: Column) -> Column:
    """The sorted set of hashes of all chains of CHAIN + 1 words (of fewer
    words: of one chain)."""
    words = F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "))
    marks = F.trim(F.regexp_replace(F.lower(text), "\\s+", " "))

    def chains(w):
        return F.sort_array(F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.size(w) - CHAIN - 1), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(CHAIN + 1)]))))

    return _bound(F.when(words == "", marks).otherwise(words), lambda t: _bound(
        F.split(t, " "), lambda w: F.when(F.size(w) > CHAIN, chains(w)).otherwise(F.array(F.xxhash64(t)))))


def fingerprint(sigs: Column) -> Column:
    """The name of a signature set: 32 hex digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(i), sigs)), 16, "0") for i in (1, 2)]))


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def near_pairs(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, likeness) of every two distinct signature sets of ``sets`` (fp,
    sigs; one row per fingerprint) that are at least ``threshold`` alike.

    Length partitions are powers of 1/threshold: alike sets differ in length
    by at most that factor, so they lie in the same or in neighbouring
    partitions.  Each set is posted under its n - ceil(threshold n) + 1
    rarest signatures, in its own partition and the next; alike sets must
    share one of these.  The join compares lengths before the sets."""
    sized = sets.select("fp", "sigs", F.size("sigs").alias("n"))
    posted = sized.select("fp", F.explode("sigs").alias("sig"))
    rarity = posted.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = posted.join(rarity, "sig", "left").groupBy("fp").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "sig"))).alias("by_rarity"))
    part = F.floor(F.log(F.col("n").cast("double")) / -F.log(F.lit(threshold)) + 1e-9)
    prefix = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1
    keyed = (sized.join(ranked, "fp").select("fp", "n", "sigs", part.alias("part"), F.explode(
        F.slice("by_rarity", F.lit(1), prefix)).alias("rare")).where("rare.df > 1"))
    left = keyed.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("sigs").alias("sa"),
                        F.col("rare.sig").alias("key"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = keyed.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("sigs").alias("sb"),
                         F.col("rare.sig").alias("key"), "part")
    # estimates know nothing of the length of the sets, so the kind of join is fixed
    pairs = left.join(right.hint("merge"), ["key", "part"]).where(
        (F.col("a") != F.col("b")) & (F.col("na") <= F.col("nb")) & (F.col("na") >= threshold * F.col("nb") - 1e-9))
    return (pairs.withColumn("likeness", likeness(F.col("sa"), F.col("sb"))).where(F.col("likeness") >= threshold)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness").distinct())


# -- neighbours in descending doc_id ----------------------------------------

def _shard_number(rows: DataFrame, n_shards: int, bounds: list[int]) -> Column:
    """The number of a row's shard, ascending in the order of descending
    doc_id (null last) and ascending text hash."""
    doc_id, shard = F.col("doc_id"), F.lit(0)
    if bounds:  # binary search for the number of bounds <= doc_id
        steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
        array = F.array(*[F.lit(b).cast("long") for b in bounds])
        shard = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda lo, s: F.when(
            (lo + s <= len(bounds)) & (F.get(array, lo + s - 1) <= doc_id), lo + s).otherwise(lo))
    shard = F.when(doc_id.isNull(), -1).otherwise(shard)
    per_id = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    total = per_id.agg(F.sum("n")).first()[0] or 0
    room = max(1, -(-total // n_shards))
    # ids of more than two shards' rows: fewer than n_shards
    hot = sorted(((r["doc_id"], -(-r["n"] // room)) for r in per_id.where(F.col("n") > 2 * room).collect()),
                 key=lambda x: (x[0] is None, -(x[0] or 0)))
    if not hot:
        return (n_shards - shard).cast("long")
    most = max(m for _, m in hot)
    above, is_hot, cut = F.lit(0), F.lit(False), F.lit(0)   # hot ids in front of the row's, is it one, its cut by the text's hash
    for i, m in hot:
        same = doc_id.isNull() if i is None else doc_id.eqNullSafe(F.lit(i).cast("long"))
        if i is not None:
            above = above + F.when(doc_id.isNull() | (doc_id < i), 1).otherwise(0)
        place = F.least(F.lit(m - 1), F.floor((F.xxhash64("text") / 2.0 ** 64 + 0.5) * m).cast("int"))
        is_hot, cut = is_hot | same, F.when(same, place).otherwise(cut)
    return ((((n_shards - shard) * (len(hot) + 1) + above) * 2 + is_hot.cast("int")) * most + cut).cast("long")


def _names(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers of which a hash partitioning into ``n`` takes each to a
    partition of its own."""
    names: dict[int, int] = {}
    step, start = 32 * n, 0
    while len(names) < n:
        of = spark.range(start, start + step).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id"))
        for r in of.collect():   # at most n rows
            names.setdefault(r["p"], r["id"])
        start += step
    return [names[p] for p in range(n)]


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): every document with the one
    after it in descending doc_id (after the last: the first).

    The texts are shuffled once: shards are doc_id ranges (one per shuffle
    partition, bounds from approximate quantiles), a window finds the next
    document inside a shard, and a shard's last document takes the first of
    the next non-empty shard, of which there is one row per shard.  An id (or
    the lack of one) that more rows share than a shard should hold is cut by
    ranges of its texts' hashes into shards of its own.  Shards are named so
    that no two of them are hashed to one task."""
    spark = docs.sparkSession
    n_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    fractions = [i / n_shards for i in range(1, n_shards)]
    found = rows.select(F.percentile_approx("doc_id", fractions, 100 * n_shards).alias("q")).first()["q"] if fractions else []
    rows = rows.withColumn("number", _shard_number(rows, n_shards, sorted(set(found or []))))
    # the numbers in use, ascending: at most n_shards + 3 for each id that is cut, and its cuts
    numbers = [r["number"] for r in rows.select("number").distinct().orderBy("number").collect()]
    parts = max(n_shards, len(numbers))
    names = _names(spark, parts)[:len(numbers)]
    named = spark.createDataFrame(list(zip(numbers, names, [*names[-1:], *names[:-1]])), "number_of long, shard long, before long")
    rows = rows.join(F.broadcast(named), F.col("number") == F.col("number_of")).select("doc_id", "text", "number", "shard", "before")
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    # the first row of every shard goes to the shard before it (around the end)
    tops = rows.groupBy("number").agg(F.max(F.struct("doc_id", F.bitwise_not(F.xxhash64("text")).alias("h"))).alias("top"))
    tops = F.broadcast(tops.select(F.col("number").alias("s"), "top"))  # at most one row per shard
    firsts = (rows.join(tops, (F.col("number") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("top.doc_id")) &
                        (F.bitwise_not(F.xxhash64("text")) == F.col("top.h")))
              .groupBy(F.col("before").alias("of_shard")).agg(F.min("text").alias("first_text"))
              .select("of_shard", "first_text", signatures(F.col("first_text")).alias("first_sigs")))
    inside = Window.partitionBy("shard").orderBy(*order)
    signed = rows.repartition(parts, "shard").select("doc_id", "shard", "text", signatures(F.col("text")).alias("sigs"))
    chained = signed.select("*", F.lead(F.struct("text", "sigs")).over(inside).alias("next"))
    # on the shard, by which the texts lie already
    return chained.join(firsts, F.col("shard") == F.col("of_shard")).select(
        "doc_id", "text", "sigs", F.coalesce(F.col("next.text"), F.col("first_text")).alias("next_text"),
        F.coalesce(F.col("next.sigs"), F.col("first_sigs")).alias("next_sigs"))


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = with_next(table(spark, sf_dir, "documents")).select(
        "doc_id", n.cast("long").alias("n_chars"), "sigs", "next_sigs",
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    rows = rows.select("doc_id", "n_chars", "sigs", "next_sigs", F.sha2("edited", 256).alias("edited_sha256"),
                       signatures(F.col("edited")).alias("edited_sigs"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
