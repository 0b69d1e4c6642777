"""Operator 13: hosts, paths and rules by plain string code, templates by a tree grown in Python."""

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from kelda.llm import plans, url_filter
from kelda.llm.url_filter import Rule

HEX = re.compile(r"(?<![0-9A-Za-z])(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{8,}(?![0-9A-Za-z])")


def parsed(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = lambda s, marks: s[: min([s.index(m) for m in marks if m in s], default=len(s))]
    host = cut(rest, "/?#")
    path = cut(rest[len(host) :], "?#")
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def grown(urls, kids, depth, confidence=0.05):
    """Template of every (host, shape), with nested loops over one host's tree at a time."""
    rate = math.sqrt(0.5 * math.log(2 / confidence))

    def walk(rows, prefix, out):
        # rows: (key, rest, said)
        done = [r for r in rows if not r[1]]
        for key, _, _ in done:
            out[key] = prefix
        rows = [r for r in rows if r[1]]
        if not rows:
            return
        sizes = Counter(r[1][0] for r in rows)
        literal = {s for s, n in sizes.items() if len(sizes) <= kids or n * kids >= len(rows)}
        branches = defaultdict(list)
        for r in rows:
            branches[r[1][0] if r[1][0] in literal else "*"].append(r)
        profiles = {}
        for name, own in branches.items():
            after = Counter(r[1][1] if len(r[1]) > 1 else None for r in own)
            seen = Counter()
            for follow, n in after.items():
                seen["end" if follow is None else "/" + follow if n * kids >= len(own) else "/*"] += n
            seen["block"] = sum(r[2] == "block" for r in own)
            seen["allow"] = sum(r[2] == "allow" for r in own)
            profiles[name] = seen
        classes = []
        for name in sorted(branches, key=lambda x: (-len(branches[x]), x)):
            n, mine = len(branches[name]), profiles[name]
            for c in classes:
                bound = rate * (n**-0.5 + c["n"] ** -0.5)
                if all(abs(mine[k] / n - c["seen"][k] / c["n"]) <= bound for k in {*mine, *c["seen"]}):
                    c["names"].append(name)
                    c["n"] += n
                    c["seen"] = c["seen"] + mine
                    break
            else:
                classes.append({"names": [name], "n": n, "seen": mine})
        for c in classes:
            label = c["names"][0] if len(c["names"]) == 1 else "{" + "|".join(sorted(c["names"])) + "}"
            walk([(k, rest[1:], said) for x in c["names"] for k, rest, said in branches[x]], f"{prefix}/{label}", out)

    by_host = defaultdict(list)
    for host, shape, said in urls:
        rest = shape[1:].split("/") if shape else []
        by_host[host].append(((host, shape), rest[:depth] + ["**"] * (len(rest) > depth), said))
    found = {}
    for rows in by_host.values():
        walk(rows, "", found)
    return found


def brute_force(rows, rules, kids, depth, purity):
    urls = []
    for key, url in rows:
        host, path = parsed(url)
        rule = rule_of(rules, host, path)
        urls.append((key, host, path, rule, re.sub("[0-9]+", "#", HEX.sub("~", path))))
    templates = grown([(h, s, r.verdict if r else None) for _, h, _, r, s in urls], kids, depth)
    told = defaultdict(Counter)
    for _, host, _, rule, shape in urls:
        told[host, templates[host, shape]][rule.verdict if rule else None] += 1
    out = []
    for key, host, path, rule, shape in urls:
        own = told[host, templates[host, shape]]
        share = (own["block"] + 1) / (own["block"] + own["allow"] + 2)
        verdict = rule.verdict if rule else "block" if share >= purity else "allow"
        out.append((key, host, path, rule.name if rule else None, verdict, templates[host, shape], share))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark, sf_dir):
    for folder in (sf_dir, "/root/testdata/sf0.1"):
        pages = [(r["page_id"], r["url"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
        got = sorted(map(tuple, plans.QUERIES["op13_url_filter"](spark, folder).collect()), key=repr)
        assert got == brute_force(pages, url_filter.RULES, url_filter.KIDS, url_filter.DEPTH, url_filter.PURITY)


RULES = [Rule("block", "a.com", "/bad/"), Rule("allow", "a.com", "/bad/good"), Rule("block", "b.org", "/spam/7")]


def made():
    rows = [(k, f"http://A.com/bad/x{k}/page.html?q=/") for k in range(30)]
    # Unlike any other branch of the host, like its blocked one, and variable names.
    rows += [(100 + k, f"https://a.com/news/{chr(97 + k)}") for k in range(26)]
    rows += [(200 + k, f"http://www.a.com/bad/x{k}/page.html") for k in range(40)]
    rows += [(300 + k, f"http://b.org/spam/{k}/{'z' * k}") for k in range(100)]
    rows += [(400 + k, f"http://b.org/{w}/{k:08x}") for k in range(20) for w in ("c", "d", "spam")]
    odd = [None, "", "no scheme", "://", "http://", "http://H?x/y", "http://h#f", "http://h/", "http://h//a//", "ftp://u://v/w"]
    rows += [(500 + k, u) for k, u in enumerate(odd)]
    rows += [(None, "http://a.com/bad/good/1"), (5, "http://a.com/bad/x5"), (5, "http://a.com/bad/x5")]
    rows += [(600, "http://deep/" + "/".join("abcdefghijkl")), (601, "http://h/" + "long/" * 5000), (602, "http://a.com/B\nc/é")]
    return rows


def test_small_tables(spark):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in made()], "page_id bigint, url string, host string, n int")
    for kids, depth, purity in ((20, 8, 0.95), (3, 2, 0.8), (5, 3, 0.6)):
        got = url_filter.judge(frame.repartition(3), RULES, kids=kids, depth=depth, purity=purity)
        assert sorted(map(tuple, got.collect()), key=repr) == brute_force(made(), RULES, kids, depth, purity)
    assert url_filter.judge(frame.where("false"), RULES).count() == 0


def test_the_method_rejects_and_keeps(spark):
    """A template of blocked urls is rejected beyond the rule; unlike ones are left alone."""
    rows = [(k, f"http://b.org/spam/7{k}") for k in range(60)] + [(100 + k, f"http://b.org/spam/{k % 7}{k}") for k in range(20)]
    rows += [(200 + k, f"http://b.org/news/2024/{k}") for k in range(60)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string"), RULES)
    said = {r["page_id"]: (r["rule"], r["verdict"]) for r in got.collect()}
    assert all(said[k] == ("b.org/spam/7", "block") for k in range(60))
    assert all(said[100 + k] == (None, "block") for k in range(20))
    assert all(said[200 + k] == (None, "allow") for k in range(60))


def test_a_node_is_bounded(spark):
    shapes = spark.range(5000).select(
        F.lit("h").alias("host"), F.concat(F.lit("/"), F.hash("id").cast("string"), F.lit("/x")).alias("shape"),
        F.lit(1).alias("n"), F.lit(0).alias("blocked"), F.lit(0).alias("allowed"),
    )
    found = url_filter.templates(shapes).select("template").distinct().collect()
    assert [r["template"] for r in found] == ["/*/x"]
