"""Tables and brute-force versions for the tests of the corpus operators."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import duckdb

TABLES = ("documents", "pages", "benchmark", "labels")
LONG_TEXT = "\n".join(f"Line {i} of a very long text with words {i % 7} {i % 11}" for i in range(20_000))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def same_rows(df, sql: str, con) -> list[str]:
    """What differs between a query and its SQL; columns are matched by name."""
    relation = con.sql(sql)
    theirs = Counter(relation.fetchall())
    mine = Counter(tuple(row[c] for c in relation.columns) for row in df.collect())
    found = [] if set(df.columns) == set(relation.columns) else [f"{df.columns} {relation.columns}"]
    for label, rows in (("extra", mine - theirs), ("missing", theirs - mine)):
        if rows:
            found.append(f"{sum(rows.values())} {label}, e.g. {next(iter(rows))}")
    return found


def plain_words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def near_classes(docs: dict[int, str | None], least: float = 0.8) -> dict[int, int]:
    """Smallest id of each document's class, by comparing all pairs that share a shingle."""
    sets = {}
    for key, text in docs.items():
        w = plain_words(text)
        sets[key] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    df = Counter(s for own in sets.values() for s in own)
    total = sum(1 for own in sets.values() if own)
    weigh = lambda s, n: n * (1 + (math.log(total / df[s]) / math.log(total) if total > 1 else 0))
    weights = {k: {s: weigh(s, n) for s, n in own.items()} for k, own in sets.items()}
    holders = defaultdict(list)
    for key in sorted(docs):
        for s in sets[key]:
            holders[s].append(key)
    root = {k: k for k in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(a, b) for keys in holders.values() for i, a in enumerate(keys) for b in keys[i + 1 :]}:
        u, v = weights[a], weights[b]
        shared = sum(min(u[s], v[s]) for s in u.keys() & v.keys())
        if shared >= least * (sum(u.values()) + sum(v.values()) - shared):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in docs}


def kept_lines(docs: dict[int, str | None]) -> dict[int, list[str] | None]:
    """Lines that stay of each document, window by window in order of id and place."""
    seen, covered = set(), defaultdict(set)
    count = lambda line: len(re.findall(r"[^\x20\x09-\x0D]+", line))
    for key in sorted(docs):
        lines = [] if docs[key] is None else docs[key].split("\n")
        n = [count(line) for line in lines]
        for i in range(len(lines)):
            sizes = [3] if i + 3 <= len(lines) and sum(n[i : i + 3]) else []
            sizes += [1] if n[i] > 50 else []
            sizes += [2] if i + 2 <= len(lines) and 50 < sum(n[i : i + 2]) else []
            for size in sizes:
                window = tuple(lines[i : i + size])
                if window in seen:
                    covered[key].update(range(i, i + size))
                seen.add(window)
    return {
        k: None if t is None else [x for i, x in enumerate(t.split("\n")) if i not in covered[k]]
        for k, t in docs.items()
    }


def benchmark_hits(docs: dict[int, str | None], items: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """Number of hit words and of words of each document."""
    known = defaultdict(set)
    for text in items.values():
        w = plain_words(text)
        size = min(13, len(w))
        known[size].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1) if size)
    out = {}
    for key, text in docs.items():
        w, hit = plain_words(text), set()
        for size, found in known.items():
            for i in range(len(w) - size + 1):
                if size and tuple(w[i : i + size]) in found:
                    hit.update(range(i, i + size))
        out[key] = (len(hit), len(w))
    return out
