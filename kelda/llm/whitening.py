"""Embedding whitening with components from an exact characteristic polynomial (operator 12).

An entry c becomes the whole number x = floor(64 c) + 1000000. The fit list has each different
vector once; its sums and sums of products are added up by Spark in whole numbers, so the scatter
n * sum(x x') - S S', which is n**2 times the covariance of the centred vectors, is exact. The
driver gets d * (d + 3) / 2 numbers for d dimensions, whatever the number of rows; the scatter's
characteristic polynomial, its roots and their vectors are worked out there (see ``charpoly``).

Every vector is then centred exactly, as n * x - S, and projected on the components over the roots
of the eigenvalues. Components are numbered by falling eigenvalue, up to ``COMPONENTS``; the sign
is such that a component's largest entry is positive. A component without variance whitens to 0.

Left out are vectors that are null, have a null or non-finite entry or one whose whole number
passes 64 bits, are empty, or are not of the table's dimension (the most frequent length; of
equally frequent ones the largest). A single vector, or equal ones, have no variance: all 0. An
empty table gives no rows. Repeated rows stay, each with its result; they count once in the fit.
A deviation beyond 64 bits is null. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelda.llm.charpoly import DIGITS, components
from kelda.llm.tables import stored

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Bits of a limb: products of limbs over a batch of rows stay exact in doubles.
LIMB = 18
_WIDTHS = (1, 2, 4, 8)


def _matrix(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows count, and their floor(SCALE * c)."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(lengths == dims)
    flat = vectors.take(pa.array(right)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)  # null becomes NaN
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(values * SCALE)
        whole = (np.abs(scaled) < 2.0**62).all(axis=1)
    return right[whole], scaled[whole].astype(np.int64)


def _packed(rows: np.ndarray) -> list[bytes]:
    """Each row's numbers in the least bytes that hold them all; equal rows alike."""
    most = np.maximum(rows.max(axis=1), -(rows.min(axis=1) + 1)) if len(rows) else np.empty(0, np.int64)
    width = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], _WIDTHS[:3], _WIDTHS[3])
    narrow = {w: rows.astype(f"<i{w}") for w in np.unique(width).tolist()}
    return [narrow[w][k].tobytes() for k, w in enumerate(width.tolist())]


def _unpacked(packed: pa.Array, dims: int) -> np.ndarray:
    raw = packed.to_pylist()
    found = np.empty((len(raw), dims), np.int64)
    widths = np.array([len(x) // dims for x in raw], np.int64)
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        found[at] = np.frombuffer(b"".join(raw[k] for k in at), f"<i{w}").reshape(-1, dims)
    return found


def _dimension(vectors: DataFrame) -> int:
    """The most frequent length; 0 if there is none."""
    lengths = vectors.select(F.size("vector").alias("d")).where("d > 0")
    most = lengths.groupBy("d").count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return most["d"] if most else 0


def _products(rows: np.ndarray) -> np.ndarray:
    """Sum of the rows' outer products, in Python's whole numbers."""
    limbs, rest = [], rows
    while True:
        low = rest & ((1 << LIMB) - 1) if len(rows) and np.abs(rest).max() >> LIMB else rest
        limbs.append(low.astype(np.float64))
        rest = (rest - low) >> LIMB
        if not rest.any():
            break
    total = np.zeros((rows.shape[1],) * 2, dtype=object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << LIMB * (i + j)
    return total


def _sums(dims: int):
    """(i, j, high, low) in two halves of 64 bits: sums of products for i <= j, of entries for j = -1, of rows for i = -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, entries = 0, np.zeros(dims, dtype=object)
        products = np.zeros((dims, dims), dtype=object)
        for batch in batches:
            for start in range(0, len(batch), 1 << 14):
                rows = _unpacked(batch.column("key").slice(start, 1 << 14), dims)
                count += len(rows)
                entries += rows.astype(object).sum(axis=0)
                products += _products(rows)
        if not count:
            return
        i, j = np.triu_indices(dims)
        values = [count, *entries, *products[i, j]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1, *range(dims), *i.tolist()], pa.int32()),
                pa.array([-1] * (1 + dims) + j.tolist(), pa.int32()),
                pa.array([Decimal(v >> 64) for v in values], pa.decimal128(38, 0)),
                pa.array([Decimal(v & ((1 << 64) - 1)) for v in values], pa.decimal128(38, 0)),
            ],
            names=["i", "j", "high", "low"],
        )

    return run


@dataclass(frozen=True)
class Whitening:
    """What a table's vectors are whitened with; sums are those of x - SHIFT."""

    dims: int
    n: int
    sums: list[int]
    scatter: list[list[int]]
    matrix: np.ndarray
    explained: list[float]
    identity_error: float = 0.0

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n * x - S of each row, in 64 bits if they suffice."""
        most = max(map(abs, self.sums), default=0) + self.n * (int(np.abs(rows).max()) if len(rows) else 0)
        if most < 1 << 62:
            return rows * self.n - np.array(self.sums, np.int64)
        return rows.astype(object) * self.n - np.array(self.sums, dtype=object)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        if centred.dtype != object and len(centred):
            most = int(np.abs(centred).max())
            if most * most * self.dims < 1 << 63:
                return (centred * centred).sum(axis=1).tolist()
        found = (centred.astype(object) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in found]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) @ self.matrix


def _solved(dims: int, n: int, sums: list[int], products: dict[tuple[int, int], int], count: int) -> Whitening:
    scatter = [
        [n * products[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)
    ]
    found = components(scatter, count)
    trace = sum(scatter[i][i] for i in range(dims))
    width = min(count, dims)
    matrix = np.zeros((dims, width))
    explained = [0.0] * width
    with localcontext() as context:
        context.prec = DIGITS
        for k, own in enumerate(found):
            # An eigenvalue of the covariance is the root over n**2, and n * x - S is n times centred.
            matrix[:, k] = [float(v / own.root.sqrt()) for v in own.vector]
            explained[k] = float(own.root / trace)
    return Whitening(dims, n, sums, scatter, matrix, explained)


def _moments(model: Whitening):
    """(i, j, value): sums of the whitened values (j = -1) and of their products, the latter centred in each task and
    moved to the common origin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = model.matrix.shape[1]
        count, mean, about = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            rows = model.whitened(model.centred(_unpacked(batch.column("key"), model.dims)))
            if not len(rows):
                continue
            own = rows.mean(axis=0)
            apart = rows - own
            shift = own - mean
            total = count + len(rows)
            about += apart.T @ apart + np.outer(shift, shift) * (count * len(rows) / total)
            mean, count = mean + shift * (len(rows) / total), total
        if not count:
            return
        i, j = np.triu_indices(width)
        values = np.concatenate([count * mean, (about + count * np.outer(mean, mean))[i, j]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*range(width), *i.tolist()], pa.int32()),
                pa.array([-1] * width + j.tolist(), pa.int32()),
                pa.array(values),
            ],
            names=["i", "j", "value"],
        )

    return run


def _identity_error(keys: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity, for components with variance."""
    sums = keys.mapInArrow(_moments(model), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("v"))
    found = {(r["i"], r["j"]): r["v"] / model.n for r in sums.collect()}
    has = [k for k, e in enumerate(model.explained) if e > 0]
    errors = [
        abs(found[i, j] - found[i, -1] * found[j, -1] - (i == j)) for i in has for j in has if i <= j
    ]
    return max(errors, default=0.0)


def _vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))


def _keys(vectors: DataFrame, dims: int) -> DataFrame:
    """The different vectors, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows = _matrix(batch.column("vector"), dims)
            yield pa.RecordBatch.from_arrays([pa.array(_packed(rows), pa.binary())], names=["key"])

    return vectors.select("vector").mapInArrow(run, "key binary").distinct()


def fit(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table's different vectors; None if it has none."""
    vectors = _vectors(table, id_col, vector_col)
    dims = _dimension(vectors)
    if not dims:
        return None
    keys = stored(_keys(vectors, dims), "fit-list")
    sums = keys.mapInArrow(_sums(dims), "i int, j int, high decimal(38,0), low decimal(38,0)")
    total = sums.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    found = {(r["i"], r["j"]): (int(r["high"]) << 64) + int(r["low"]) for r in total}
    if not found:
        return None
    model = _solved(dims, found[-1, -1], [found[i, -1] for i in range(dims)], found, count)
    error = _identity_error(keys, model)
    return Whitening(*(getattr(model, f) for f in ("dims", "n", "sums", "scatter", "matrix", "explained")), error)


def whiten(table: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, deviation and whitened (one value a component) of every row that counts."""
    vectors = _vectors(table, id_col, vector_col)
    kind = vectors.schema["id"].dataType.simpleString()
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        width = own.matrix.shape[1]
        for batch in batches:
            at, rows = _matrix(batch.column("vector"), own.dims)
            centred = own.centred(rows)
            values = pa.array(own.whitened(centred).ravel())
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(at)),
                    pa.array(own.deviations(centred), pa.int64()),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                names=["id", "deviation", "whitened"],
            )

    found = vectors.mapInArrow(run, f"id {kind}, deviation bigint, whitened array<double>")
    return found.withColumnRenamed("id", id_col)


def report(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each vector and component, with the figures of the fit."""
    model = fit(table, id_col, vector_col)
    if model is None:
        kind = table.schema[id_col].dataType.simpleString()
        names = f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return table.sparkSession.createDataFrame([], names)
    rows = whiten(table, model, id_col, vector_col)
    long = rows.select(id_col, "deviation", F.posexplode("whitened").alias("k", "value"))
    explained = F.array(*[F.lit(x) for x in model.explained])
    return long.select(
        id_col,
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
