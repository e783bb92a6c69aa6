import random
import re
from collections import Counter, defaultdict

from rewardseg.llm import urls

ODD = ["http://a.com", None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1", "http://www.example.com/en/x?y#z",
       "http://www.example.com/EN/x", "http://examplecom/en/", "ftp://x.net/fr/1/2/3/4/5/6/7", "http://x.net/es", "http://x.net/es/",
       "a://b://c.net/fr/", "http://h.org//x//", "http://net/es/q", "http://x.net?/es/", "http://x\n.com/\n", "https://É.COM/é"]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def best_rule(host, path):
    fits = [r for r, _ in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def shape(path):
    path = re.sub("[0-9]+", "*", re.sub("(?i)[0-9a-f-]{16,}", "*", path))
    if path == "":
        return ()
    return tuple((path[1:] if path.startswith("/") else path).split("/"))


def kind(segment):
    return "end" if segment is None else "any" if segment == "*" else "part" if "*" in segment else "name"


def by_label(cells):
    out = Counter()
    for (label, _), n in cells.items():
        out[label] += n
    return out


def chi_square(branch, whole):
    n, total, chi = sum(branch.values()), sum(whole.values()), 0.0
    for cell, both in whole.items():
        for size in (n, total - n):
            if size:
                chi += (branch[cell] - n * both / total) ** 2 / (size * both / total)
    return chi


def brute(pages):
    """The verdict and template of every page, by loops."""
    parsed = [(i, *parse(u)) for i, u in pages]
    rule = [best_rule(h, p) for _, h, p in parsed]
    verdict = dict(urls.RULES)
    counts = Counter((h, shape(p), verdict.get(r, "none")) for (_, h, p), r in zip(parsed, rule))
    node, level = {(h, s): "" for h, s, _ in counts}, 0
    alive = set(node)
    while alive:
        cells = defaultdict(lambda: defaultdict(Counter))
        alive = {(h, s) for h, s in alive if level < len(s)}
        for (h, s, label), n in counts.items():
            if (h, s) in alive:
                after = s[level + 1] if level + 1 < len(s) else None
                cells[h, node[h, s]][s[level]][label, kind(after)] += n
        name = {}
        for key, branches in cells.items():
            whole = sum(branches.values(), Counter())
            total = sum(whole.values())
            if total < urls.MIN_SUPPORT or len({label for label, _ in whole}) == 1:
                continue
            for seg, c in branches.items():
                n = sum(c.values())
                if n >= urls.MIN_SUPPORT:
                    told = n == total or chi_square(c, whole) >= urls.CRITICAL
                else:
                    told = any(label != "none" for label, _ in c) and chi_square(by_label(c), by_label(whole)) >= urls.CRITICAL_LABELS
                name[(*key, seg)] = seg if seg == "" or seg != "*" and told else "*"
        split = {x for x in alive if (x[0], node[x], x[1][level]) in name}
        node |= {x: node[x] + "/" + name.get((x[0], node[x], x[1][level]), "**") for x in alive}
        alive, level = split, level + 1
    share = defaultdict(Counter)
    for (h, s, label), n in counts.items():
        share[h, node[h, s]][label] += n
    out = []
    for (i, h, p), r in zip(parsed, rule):
        c = share[h, node[h, shape(p)]]
        blocked = (c["block"] + urls.PRIOR / 2) / (c["block"] + c["allow"] + urls.PRIOR)
        out.append((i, h, p, r, verdict.get(r) or ("block" if blocked >= urls.REJECT else "allow"), node[h, shape(p)], blocked))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(2)
    pages = list(enumerate(ODD))
    for i in range(1500):
        host = rng.choice(["big.net", "big.net", "big.net", "www.example.com", "s.org", f"h{i % 40}.net"])
        lang = rng.choice(["en", "fr", "es", "de"])
        tail = rng.choice([f"{i}", f"{i}.html", f"{i}/", f"slug-{i}x", "about", f"a/b/c/d/{i}", "deadbeefdeadbeef0123"])
        pages.append((1000 + i, f"https://{host}/{lang}/{tail}"))
    pages += [(None, "http://big.net/fr/1"), (1000, "http://big.net/fr/1"), (1000, "http://big.net/fr/1")]
    data = spark.createDataFrame([(i, u, "x", "clash", "clash") for i, u in pages], "page_id long, url string, html string, host string, rule string")
    got = urls.filter_urls(data.repartition(4)).collect()
    key = lambda r: str(r[:6])
    want = sorted(brute(pages), key=key)
    got = sorted((tuple(r) for r in got), key=key)
    assert [r[:6] for r in got] == [r[:6] for r in want]
    assert all(abs(a[6] - b[6]) < 1e-12 for a, b in zip(got, want))
    assert {r[4] for r in got} == {"allow", "block"} and len({r[5] for r in got}) > 5


def test_empty_table_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.filter_urls(none).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/fr/1")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in urls.filter_urls(one, rules=()).collect()] == [(None, "allow")]


def test_rare_blocked_branches_do_not_mark_all_others(spark):
    """150 unlabelled sections of 20 pages beside one of 20 blocked pages, and 400 of 3 beside one of 5: the clean pages
    stay; paths that differ deep down are told apart."""
    rows = [f"http://many.net/section{chr(97 + i // 26)}{chr(97 + i % 26)}/{j}" for i in range(150) for j in range(20)]
    rows += [f"http://many.net/es/{j}" for j in range(20)]
    rows += [f"http://few.net/part{chr(97 + i // 26)}{chr(97 + i % 26)}/{j}" for i in range(400) for j in range(3)] + [f"http://few.net/fr/{j}" for j in range(5)]
    rules = (*urls.RULES, ("deep.org/a/b/c/d/bad/", "block"), ("deep.org/a/b/c/d/good/", "allow"))
    rows += [f"http://deep.org/a/b/c/d/{x}/{j}" for x in ("bad", "good", "other") for j in range(30)]
    data = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string")
    got = urls.filter_urls(data, rules).collect()
    blocked = {r.host + r.path.rsplit("/", 1)[0] for r in got if r.verdict == "block"}
    assert blocked == {"many.net/es", "few.net/fr", "deep.org/a/b/c/d/bad"}
    deep = {r.path.split("/")[5]: r.template for r in got if r.host == "deep.org"}
    assert deep == {x: f"/a/b/c/d/{x}/**" if x != "other" else deep["other"] for x in deep} and deep["other"] not in (deep["bad"], deep["good"])


def test_long_paths(spark):
    rows = [f"http://x.net/{'es' if i % 2 else 'de'}/" + "/".join(["s"] * (50 + i % 40)) for i in range(60)] + ["http://x.net/" + "a/" * 5000]
    got = urls.filter_urls(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")).collect()
    assert all((r.verdict == "block") == r.path.startswith("/es/") for r in got)
