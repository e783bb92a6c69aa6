"""URL filter: explicit rules first, then a path-template tree per host.

Rules (host, path) name a host with all its subdomains and a path prefix;
the longest rule that fits gives the verdict.  Urls that a rule decided are
the labelled examples of the tree.

The tree is built level by level from distinct shape paths (digit runs and
long hexadecimal runs become ``*``) with their counts.  A node is split if at
least ``MIN_SUPPORT`` of its urls go on and these do not all have the same
label (blocked, allowed, none); else their rest is one ``**``.  In a node
that is split, each branch is compared with all of it:

* one of ``MIN_SUPPORT`` or more urls over (label x kind of the next
  segment); if the chi-square statistic does not tell it from the node, it
  merges into ``*``.  An only branch stays;
* a rarer one over the label alone, and only if it has labelled urls; so a
  few blocked urls do not mark the ``*`` of all rare branches.

Levels go on until no node is split.  A template is rejected when the share
of blocked urls among its labelled ones, smoothed towards 1/2, reaches
``REJECT``; one without labelled urls is allowed.

Branches are joined with the sums of their node, so a node may have any
number of them; the joins on a hot node are one adaptive execution splits.
Everything runs on DataFrame functions.

Defined cases: a null url, or one without ``://``, has empty host and path,
no rule, and is judged by the template of the empty host; null page_ids and
repeated rows are judged one by one; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rewardseg.llm.common import UPPER, LOWER, stage, table

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
MIN_SUPPORT = 10
CRITICAL = 24.7        # chi-square, 11 degrees of freedom, 0.99
CRITICAL_LABELS = 9.2  # chi-square, 2 degrees of freedom, 0.99
SQL_LEVELS = 6         # levels that the SQL spells out
PRIOR = 4.0            # weight of the neutral share 1/2
REJECT = 0.7
LABELS, KINDS = ("block", "allow", "none"), ("end", "any", "part", "name")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule string that fits, or null (rules are a short list)."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found = F.when(fits, rule).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """Shape segments of a path."""
    shape = F.regexp_replace(F.regexp_replace(path, "(?i)[0-9a-f-]{16,}", "*"), "[0-9]+", "*")
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(shape, "^/", ""), "/"))


def _kind(segment: Column) -> Column:
    return (F.when(segment.isNull(), "end").when(segment == "*", "any")
            .when(segment.contains("*"), "part").otherwise("name"))


def _chi(own: list[Column], whole: list[Column], n: Column, of: Column) -> Column:
    """The chi-square statistic of a branch and the rest of its node."""
    chi = F.lit(0.0)
    for c, everyone in zip(own, whole):
        expected, rest = n * everyone / of, (of - n) * everyone / of
        part = (c - expected) * (c - expected)
        chi = chi + F.when(expected > 0, part / expected).otherwise(0.0) + F.when(rest > 0, part / rest).otherwise(0.0)
    return chi


def templates(urls: DataFrame) -> DataFrame:
    """``urls`` (host, shape, label) -> (host, shape, template, n, blocked,
    allowed) per distinct host and shape path."""
    labels = [F.sum(F.when(F.col("label") == v, 1).otherwise(0)).alias(v) for v in LABELS]
    cells = [(v, k) for v in LABELS for k in KINDS]
    names = [f"{v}_{k}" for v, k in cells]
    counted = [F.sum(F.when(_kind(F.col("next")) == k, F.col(v)).otherwise(0)) for v, k in cells]
    total = lambda columns: reduce(lambda a, b: a + b, columns)
    state, done, level = stage(urls.groupBy("host", "shape").agg(*labels).select("*", F.lit("").alias("node")), "url-shapes"), [], 0
    while True:
        at = state.select("*", F.get("shape", F.lit(level)).alias("seg"), F.get("shape", F.lit(level + 1)).alias("next"))
        done.append(at.where("seg is null").select("host", "shape", *LABELS, "node"))
        living = at.where("seg is not null")
        whole = living.groupBy(F.col("host").alias("h"), F.col("node").alias("o")).agg(
            *[c.alias(f"of_{n}") for c, n in zip(counted, names)], *[F.sum(v).alias(f"of_{v}") for v in LABELS])
        whole = whole.withColumn("of", total([F.col(f"of_{v}") for v in LABELS]))
        mixed = total([(F.col(f"of_{v}") > 0).cast("int") for v in LABELS]) > 1
        branches = living.groupBy("host", "node", "seg").agg(*[c.alias(n) for c, n in zip(counted, names)], *[F.sum(v).alias(v) for v in LABELS])
        branches = branches.withColumn("n", total([F.col(v) for v in LABELS])).join(
            whole.where((F.col("of") >= MIN_SUPPORT) & mixed), (F.col("host") == F.col("h")) & (F.col("node") == F.col("o")))
        n, of = F.col("n"), F.col("of")
        told = F.when(n >= MIN_SUPPORT, (n == of) | (_chi([F.col(c) for c in names], [F.col(f"of_{c}") for c in names], n, of) >= CRITICAL)).otherwise(
            (F.col("block") + F.col("allow") > 0) & (_chi([F.col(v) for v in LABELS], [F.col(f"of_{v}") for v in LABELS], n, of) >= CRITICAL_LABELS))
        judged = branches.select(F.col("host").alias("h"), F.col("node").alias("o"), F.col("seg").alias("s"),
                                 ((F.col("seg") == "") | (F.col("seg") != "*") & told).alias("kept"))
        same = (F.col("host") == F.col("h")) & (F.col("node") == F.col("o")) & (F.col("seg") == F.col("s"))
        after = stage(living.join(judged, same, "left").select("host", "shape", *LABELS, "kept", F.concat("node", F.lit("/"), F.when(
            F.col("kept").isNull(), "**").when(F.col("kept"), F.col("seg")).otherwise("*")).alias("node")), "url-tree")
        done.append(after.where("kept is null").drop("kept"))
        state, level = after.where("kept is not null").drop("kept"), level + 1
        if state.isEmpty():
            return reduce(DataFrame.unionByName, done).withColumnRenamed("node", "template")


def judge_templates(tree: DataFrame) -> DataFrame:
    """(host, shape, template, blocked_share, rejected)."""
    share = (F.sum("block") + PRIOR / 2) / (F.sum("block") + F.sum("allow") + PRIOR)
    judged = tree.groupBy(F.col("host").alias("h"), F.col("template").alias("t")).agg(share.alias("blocked_share"))
    return tree.join(judged, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t"))).select(
        F.col("host").alias("tree_host"), F.col("shape").alias("tree_shape"), "template", "blocked_share",
        (F.col("blocked_share") >= REJECT).alias("rejected"))


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, blocked_share."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("rule"), segments(F.col("path")).alias("shape"))
    verdicts = F.create_map(*[x for rule, verdict in rules for x in (F.lit(rule), F.lit(verdict))]) if rules else None
    rows = rows.withColumn("by_rule", F.when(F.col("rule").isNotNull(), F.element_at(verdicts, F.col("rule")))
                           if rules else F.lit(None).cast("string"))
    tree = templates(rows.select("host", "shape", F.coalesce("by_rule", F.lit("none")).alias("label")))
    judged = judge_templates(tree)
    return rows.join(judged, (F.col("host") == F.col("tree_host")) & (F.col("shape") == F.col("tree_shape"))).select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template", "blocked_share")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op1_sql(rules=RULES) -> str:
    """The same filter in DuckDB SQL, one block of tables per level; a node
    that is still split after SQL_LEVELS would need more."""
    def text(v):
        return "'" + v.replace("'", "''") + "'"

    cases = []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        domain, slash, rest = rule.partition("/")
        cases.append((f"(host = {text(domain)} OR suffix(host, {text('.' + domain)})) AND prefix(path, {text(slash + rest)})", rule, verdict))
    rule_case = "CASE " + " ".join(f"WHEN {c} THEN {text(r)}" for c, r, _ in cases) + " END"
    verdict_case = "CASE rule " + " ".join(f"WHEN {text(r)} THEN {text(v)}" for _, r, v in cases) + " END"
    kind = "CASE WHEN next IS NULL THEN 'end' WHEN next = '*' THEN 'any' WHEN contains(next, '*') THEN 'part' ELSE 'name' END"
    names = [f"{v}_{k}" for v in LABELS for k in KINDS]
    cells = ", ".join(f'coalesce(sum("{v}") FILTER (kind = {text(k)}), 0)::DOUBLE AS {v}_{k}' for v in LABELS for k in KINDS)
    sums = ", ".join(f'sum("{v}")::DOUBLE AS {v}_' for v in LABELS)

    def chi(columns):
        return " + ".join(
            f"CASE WHEN n * of_{c} > 0 THEN ({c} - n * of_{c} / whole) ** 2 / (n * of_{c} / whole) ELSE 0 END"
            f" + CASE WHEN (whole - n) * of_{c} > 0 THEN ({c} - n * of_{c} / whole) ** 2 / ((whole - n) * of_{c} / whole) ELSE 0 END"
            for c in columns)
    of_node = ", ".join(f"sum({c}) OVER node_of AS of_{c}" for c in [*names, *[f"{v}_" for v in LABELS]])
    kinds = " + ".join(f"(of_{v}_ > 0)::INTEGER" for v in LABELS)
    levels = []
    for i in range(SQL_LEVELS):
        levels.append(f"""
at{i} AS (SELECT *, shape[{i + 1}] AS seg, shape[{i + 2}] AS next FROM state{i} WHERE alive),
branch{i} AS (
  SELECT host, node, seg, {cells}, {sums}, sum("block" + "allow" + "none")::DOUBLE AS n
  FROM (SELECT *, {kind} AS kind FROM at{i} WHERE seg IS NOT NULL) GROUP BY host, node, seg),
judged{i} AS (
  SELECT host, node, seg, seg = '' OR (seg <> '*' AND CASE WHEN n >= {MIN_SUPPORT} THEN n = whole OR {chi(names)} >= {CRITICAL}
           ELSE block_ + allow_ > 0 AND {chi([f"{v}_" for v in LABELS])} >= {CRITICAL_LABELS} END) AS kept
  FROM (SELECT *, sum(n) OVER node_of AS whole, {of_node} FROM branch{i} WINDOW node_of AS (PARTITION BY host, node))
  WHERE whole >= {MIN_SUPPORT} AND {kinds} > 1),
state{i + 1} AS (
  SELECT host, shape, "block", "allow", "none", FALSE AS alive, node FROM state{i} WHERE NOT alive
  UNION ALL
  SELECT a.host, a.shape, "block", "allow", "none", coalesce(kept IS NOT NULL, FALSE) AS alive,
         CASE WHEN a.seg IS NULL THEN a.node ELSE a.node || '/' || CASE WHEN kept IS NULL THEN '**' WHEN kept THEN a.seg ELSE '*' END END AS node
  FROM at{i} a LEFT JOIN judged{i} j ON j.host = a.host AND j.node = a.node AND j.seg = a.seg)""")
    return f"""WITH parsed AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT *, {rule_case} AS rule FROM parsed),
cut AS (
  SELECT *, {verdict_case} AS by_rule, string_split(regexp_replace(regexp_replace(regexp_replace(path,
           '(?i)[0-9a-f-]{{16,}}', '*', 'g'), '[0-9]+', '*', 'g'), '^/', ''), '/') AS parts FROM ruled),
shaped AS (
  SELECT *, CASE WHEN path = '' THEN [] ELSE parts END AS shape FROM cut),
state0 AS (
  SELECT host, shape, count(*) FILTER (by_rule = 'block') AS "block", count(*) FILTER (by_rule = 'allow') AS "allow",
         count(*) FILTER (by_rule IS NULL) AS "none", TRUE AS alive, '' AS node FROM shaped GROUP BY host, shape),{",".join(levels)},
judged AS (
  SELECT host, node, (sum("block") + {PRIOR / 2}::DOUBLE) / (sum("block") + sum("allow") + {PRIOR}::DOUBLE) AS blocked_share
  FROM state{SQL_LEVELS} GROUP BY host, node)
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN blocked_share >= {REJECT}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
       node AS template, blocked_share
FROM shaped JOIN state{SQL_LEVELS} USING (host, shape) JOIN judged USING (host, node)"""
