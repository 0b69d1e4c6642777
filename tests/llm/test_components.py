"""Connected components against a union-find."""

import random

import pytest

from kelda.llm.components import components


def smallest(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in root}


def chain(n):
    order = random.Random(3).sample(range(n), n)
    return list(zip(order, order[1:]))


CASES = {
    "chain": chain(60),
    "stars": [(h, 100 * h + k) for h in (5, 2, 9) for k in range(1, 40)] + [(5, 9), (940, 241)],
    "leaf of two hubs": [(1, 10), (2, 10), (3, 11), (2, 11), (7, 8), (8, 7), (20, 21)],
    "random": [(random.Random(k).randint(0, 80), random.Random(-k).randint(0, 80)) for k in range(1, 60)],
    "falling": [(k + 1, k) for k in range(30)] + [(50, 40), (60, 50), (60, 55)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    links = [x for x in CASES[name] if x[0] != x[1]]
    frame = spark.createDataFrame(links * 2 + [(3, 3)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in components(frame).collect()}
    assert got == smallest(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
