"""URL filtering by a path-template tree (operator 13).

Rules decide the urls they fit; the longest wins. What they decide are the labels from which the
tree learns about the other urls of the same hosts.

A path's variable parts, digits and identifiers of hexadecimal digits, become ``#`` and ``~`` at
once, so urls are first added up to one row for each host and shape of a path. The tree of a
host is then grown a segment at a time. A node with more than ``KIDS`` children keeps those that
have a ``KIDS``-th of its urls or more, the others become the wildcard ``*``. Then branches of a
node that are statistically similar are merged, largest first: the shares of urls that end
there, go on with each next segment, are blocked or are allowed may differ by no more than
Hoeffding's bound. A merged branch grows on as one. Segments beyond ``DEPTH`` are one ``**``.

A template is rejected if its smoothed purity, (blocked + 1) / (blocked + allowed + 2) of its
labelled urls, is ``PURITY`` or more; one without labels has a purity of one half.

A null url, or one without ``://``, has an empty host and path, and the template of those. A
null or repeated page id is a row like any other; equal urls get equal verdicts. Extra columns are
not read; an empty table gives no rows. Only the joins touch pages; the tree is grown from shapes,
where a busy host has as many rows as its paths have shapes, and a node's branches and what
follows them are bounded by ``KIDS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelda.llm.tables import stored

KIDS, DEPTH, PURITY, CONFIDENCE = 20, 8, 0.95, 0.05
DIGITS, HEX = "[0-9]+", "(?<![0-9A-Za-z])(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{8,}(?![0-9A-Za-z])"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and all paths that begin so."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda k: F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def fitting_rule(rules: Sequence[Rule], host: str, path: str) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (ties: the first by name); null if none does."""
    name, verdict = (F.lit(None).cast("string") for _ in range(2))
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name), reverse=False):
        own = (F.col(host) == rule.host) | F.endswith(F.col(host), F.lit(f".{rule.host}"))
        fits = own & F.startswith(F.col(path), F.lit(rule.path))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def shape_of(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, HEX, "~"), DIGITS, "#")


def similar(first: dict[str, int], n: int, second: dict[str, int], m: int, confidence: float = CONFIDENCE) -> bool:
    """Whether all shares of two branches of n and m urls differ by no more than chance allows."""
    bound = math.sqrt(0.5 * math.log(2 / confidence)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    return all(abs(first.get(k, 0) / n - second.get(k, 0) / m) <= bound for k in first.keys() | second.keys())


def merged(branches: list[tuple[str, int, dict[str, int]]], confidence: float = CONFIDENCE) -> dict[str, str]:
    """The class of each branch (name, urls, counts): in order of size (ties: by name) a branch
    joins the first class that it is similar to. A class is named by its branches in order."""
    classes: list[tuple[list[str], int, dict[str, int]]] = []
    for name, n, counts in sorted(branches, key=lambda b: (-b[1], b[0])):
        for k, (names, m, sums) in enumerate(classes):
            if similar(counts, n, sums, m, confidence):
                both = {x: sums.get(x, 0) + counts.get(x, 0) for x in sums.keys() | counts.keys()}
                classes[k] = ([*names, name], m + n, both)
                break
        else:
            classes.append(([name], n, counts))
    label = lambda names: names[0] if len(names) == 1 else "{" + "|".join(sorted(names)) + "}"
    return {name: label(names) for names, _, _ in classes for name in names}


def _merge_nodes(confidence: float):
    """Of nodes with their branches: the class of every branch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, str, str, str]] = []
            for host, prefix, rows in zip(*(batch.column(c).to_pylist() for c in ("host", "prefix", "rows"))):
                branches: dict[str, tuple[int, dict[str, int]]] = {}
                for row in rows:
                    counts = branches.setdefault(row["branch"], (row["n"], {}))[1]
                    counts[row["key"]] = row["times"]
                classes = merged([(name, n, counts) for name, (n, counts) in branches.items()], confidence)
                found += [(host, prefix, name, own) for name, own in classes.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in found], pa.string()) for k in range(4)], names=["host", "prefix", "branch", "class"]
            )

    return run


def _sums(*more: Column) -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")] + list(more)


def _step(tree: DataFrame, kids: int, confidence: float) -> DataFrame:
    """Where each child of the tree's open nodes goes: (host, prefix, segment, class)."""
    node = ["host", "prefix"]
    seen = stored(
        tree.groupBy(*node, F.get("rest", F.lit(0)).alias("segment"), F.get("rest", F.lit(1)).alias("next")).agg(*_sums()),
        "tree-counts",
    )
    children = seen.groupBy(*node, "segment").agg(F.sum("n").alias("n"))
    sizes = children.groupBy(*node).agg(F.count("*").alias("kids"), F.sum("n").alias("total"))
    kept = (F.col("kids") <= kids) | (F.col("n") * kids >= F.col("total"))
    branches = stored(
        children.join(sizes, node).select(*node, "segment", F.when(kept, F.col("segment")).otherwise("*").alias("branch")),
        "tree-branches",
    )
    placed = seen.join(branches, [*node, "segment"])
    # What follows a branch: next segments that have a share of its urls, other ones together.
    follow = placed.groupBy(*node, "branch", "next").agg(*_sums())
    whole = stored(follow.groupBy(*node, "branch").agg(*_sums()), "tree-nodes")
    follow = follow.select(*node, "branch", "next", F.col("n").alias("times")).join(whole, [*node, "branch"])
    frequent = F.col("times") * kids >= F.col("n")
    key = F.when(F.col("next").isNull(), "end").when(frequent, F.concat(F.lit("/"), "next")).otherwise("/*")
    next_rows = follow.groupBy(*node, "branch", "n", key.alias("key")).agg(F.sum("times").alias("times"))
    labels = whole.select(
        *node, "branch", "n", F.expr("stack(2, 'blocked', blocked, 'allowed', allowed) AS (key, times)")
    )
    rows = next_rows.unionByName(labels).groupBy(*node).agg(F.collect_list(F.struct("branch", "n", "key", "times")).alias("rows"))
    classes = rows.mapInArrow(_merge_nodes(confidence), "host string, prefix string, branch string, class string")
    return stored(branches.join(classes, [*node, "branch"]).select(*node, "segment", "class"), "tree-steps")


def templates(
    shapes: DataFrame, kids: int = KIDS, depth: int = DEPTH, confidence: float = CONFIDENCE
) -> DataFrame:
    """(host, shape, template) from (host, shape, n, blocked, allowed)."""
    segments = F.split(F.expr("substring(shape, 2)"), "/")
    # A shape without a slash is the host's root itself.
    cut = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(segments)
    tail = F.when(F.size("s") > depth, F.concat(F.slice("s", 1, depth), F.array(F.lit("**")))).otherwise(F.col("s"))
    tree = shapes.withColumn("s", cut).select(
        "host", "shape", "n", "blocked", "allowed", F.lit("").alias("prefix"), tail.alias("rest")
    )
    tree = stored(tree, "tree")
    done = [tree.where(F.size("rest") == 0)]
    growing = tree.where(F.size("rest") > 0)
    while not growing.isEmpty():
        steps = _step(growing, kids, confidence)
        grown = growing.withColumn("segment", F.get("rest", F.lit(0))).join(steps, ["host", "prefix", "segment"])
        tree = stored(
            grown.select(
                "host",
                "shape",
                "n",
                "blocked",
                "allowed",
                F.concat("prefix", F.lit("/"), "class").alias("prefix"),
                F.expr("slice(rest, 2, size(rest) - 1)").alias("rest"),
            ),
            "tree",
        )
        done.append(tree.where(F.size("rest") == 0))
        growing = tree.where(F.size("rest") > 0)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.select("host", "shape", "n", "blocked", "allowed", F.col("prefix").alias("template"))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    kids: int = KIDS,
    depth: int = DEPTH,
    purity: float = PURITY,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Every row's id, host, path, rule and verdict; also its template and that one's purity."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    named = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, said = fitting_rule(rules, "host", "path")
    urls = named.select("*", rule.alias("rule"), said.alias("said"), shape_of(F.col("path")).alias("shape"))
    is_ = lambda verdict: F.when(F.col("said") == verdict, 1).otherwise(0)
    shapes = stored(
        urls.groupBy("host", "shape").agg(
            F.count("*").alias("n"), F.sum(is_("block")).alias("blocked"), F.sum(is_("allow")).alias("allowed")
        ),
        "shapes",
    )
    found = stored(templates(shapes, kids, depth, confidence), "templates")
    score = (F.sum("blocked") + 1) / (F.sum("blocked") + F.sum("allowed") + 2)
    scored = found.groupBy("host", "template").agg(score.alias("purity"))
    known = stored(found.select("host", "shape", "template").join(scored, ["host", "template"]), "verdicts")
    learned = F.when(F.col("purity") >= purity, "block").otherwise("allow")
    return urls.join(known, ["host", "shape"]).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("said", learned).alias("verdict"),
        "template",
        "purity",
    )
