"""Operator 12: exact polynomials, roots and vectors, and whitening against double precision."""

import math
import random
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pytest

from kelda.llm import charpoly, whitening


def determinant(matrix):
    """By elimination in fractions."""
    a = [[Fraction(x) for x in row] for row in matrix]
    found = Fraction(1)
    for k in range(len(a)):
        pivot = next((i for i in range(k, len(a)) if a[i][k]), None)
        if pivot is None:
            return 0
        if pivot != k:
            a[k], a[pivot], found = a[pivot], a[k], -found
        found *= a[k][k]
        for i in range(k + 1, len(a)):
            factor = a[i][k] / a[k][k]
            a[i] = [x - factor * y for x, y in zip(a[i], a[k])]
    return found


def gram(d, rows, seed, most=50):
    draw = random.Random(seed)
    v = [[draw.randint(-most, most) for _ in range(d)] for _ in range(rows)]
    return [[sum(r[i] * r[j] for r in v) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d, rows, most", [(1, 3, 9), (2, 1, 9), (4, 2, 9), (7, 9, 10**9), (9, 20, 3)])
def test_polynomial_is_exact(d, rows, most):
    matrix = gram(d, rows, d, most)
    coefficients = charpoly.characteristic(matrix)
    for x in (-3, 0, 1, 5, 10**6):
        shifted = [[(x if i == j else 0) - v for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        assert sum(c * x**k for k, c in enumerate(coefficients)) == determinant(shifted)


def test_roots_with_multiplicity():
    # (x - 1)^2 (x - 3) (x - 5)^3 x
    coefficients = [1]
    for root in (1, 1, 3, 5, 5, 5, 0):
        coefficients = [a - root * b for a, b in zip([0, *coefficients], [*coefficients, 0])]
    assert [charpoly.roots_above(coefficients, at, 1) for at in (0, 1, 2, 3, 6, 9, 10)] == [6, 6, 4, 4, 3, 3, 0]
    one = 1 << charpoly.FRACTION
    assert charpoly.largest_roots(coefficients, 16) == [(5 * one, 3), (3 * one, 1), (one, 2)]
    assert charpoly.largest_roots(coefficients, 2) == [(5 * one, 3)]


def test_vectors_of_close_and_equal_roots():
    close = [[10**12, 1, 0], [1, 10**12, 0], [0, 0, 7]]
    found = charpoly.components(close, 3)
    assert [c.root for c in found] == [10**12 + 1, 10**12 - 1, 7]
    half = math.sqrt(0.5)
    assert [abs(float(x)) for x in found[0].vector] == pytest.approx([half, half, 0], abs=1e-16)
    equal = [[4 if i == j else 1 for j in range(5)] for i in range(5)]
    found = charpoly.components(equal, 4)
    v = np.array([[float(x) for x in c.vector] for c in found])
    assert [float(c.root) for c in found] == [8, 3, 3, 3]
    assert np.abs(v @ v.T - np.eye(4)).max() < 1e-15
    assert np.abs(np.array(equal) @ v.T - v.T * [8, 3, 3, 3]).max() < 1e-14
    assert charpoly.components([[0, 0], [0, 0]], 4) == []


def test_residual_has_many_digits():
    matrix = gram(12, 30, 4, 1000)
    with localcontext() as context:
        context.prec = charpoly.DIGITS
        for c in charpoly.components(matrix, 5):
            rest = [sum(Decimal(a) * x for a, x in zip(row, c.vector)) - c.root * c.vector[i] for i, row in enumerate(matrix)]
            assert max(map(abs, rest)) < Decimal(10) ** -35


def test_packed_keys():
    rows = np.array([[1, -1], [127, -128], [128, 0], [0, -32769], [1 << 40, 5], [-(1 << 61), 0]], np.int64)
    packed = whitening._packed(rows)
    assert [len(x) for x in packed] == [2, 2, 4, 8, 16, 16]
    import pyarrow as pa

    assert (whitening._unpacked(pa.array(packed), 2) == rows).all()
    assert (whitening._products(rows) == rows.astype(object).T @ rows.astype(object)).all()


def by_component(df):
    found = {}
    for r in df.collect():
        found.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    return found


def test_query_equals_double_precision(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    # Copies count once, rows that do not count change nothing.
    more = spark.createDataFrame([(-1, None), (-2, [1.0, None]), (-3, [float("inf")] * 64), (-4, []), (-5, [1.0])], "vec_id bigint, embedding array<float>")
    doubled = table.select("vec_id", "embedding").unionByName(table.where("vec_id < 50").selectExpr("-100 - vec_id AS vec_id", "embedding"))
    got = whitening.report(doubled.unionByName(more)).toPandas()
    rows = doubled.toPandas().sort_values("vec_id")
    x = np.floor(np.stack(rows.embedding).astype(float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    wanted = (n * x - total) / n @ u / np.sqrt(e)
    got = got.sort_values(["vec_id", "component"])
    assert set(got.n) == {n} and len(got) == 16 * len(rows)
    assert (got.vec_id.to_numpy().reshape(-1, 16)[:, 0] == rows.vec_id.to_numpy()).all()
    z = got.whitened.to_numpy().reshape(-1, 16)
    assert np.abs(z * np.sign((z * wanted).sum(axis=0)) - wanted).max() < 1e-10
    assert (got.deviation.to_numpy().reshape(-1, 16)[:, 0] == ((n * x - total) ** 2).sum(axis=1)).all()
    assert np.abs(got.explained.to_numpy()[:16] - e / np.trace(v)).max() < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-12


def test_edges(spark):
    make = lambda rows: spark.createDataFrame([(*r, 5) for r in rows], "vec_id bigint, embedding array<double>, n int")
    assert whitening.report(make([])).count() == 0
    assert whitening.report(make([(1, None), (2, [float("nan")]), (3, [1e300])])).count() == 0
    same = whitening.report(make([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in same] == [(1, 0, 0.0, 0.0)] * 6
    # One direction only: the second component has no variance.
    line = by_component(whitening.report(make([(k, [k / 64, 2 * k / 64]) for k in range(5)])))
    values = [line[key][1]["whitened"] for key in sorted(line)]
    assert sorted(values) == pytest.approx([-math.sqrt(2), -math.sqrt(0.5), 0, math.sqrt(0.5), math.sqrt(2)])
    assert all(r[2]["whitened"] == 0 and r[1]["explained"] == 1 for r in line.values())
    wide = whitening.report(make([(1, [1e15, 0.0]), (2, [0.0, 1.0]), (3, [5.0, 5.0])])).collect()
    assert all(r["deviation"] is None for r in wide) and len(wide) == 6
