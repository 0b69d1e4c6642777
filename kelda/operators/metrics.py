"""Summary tables and metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelda.functions.ordered import BUSY, CHUNK, bucket_of, chunk_busy, running_sum
from kelda.sources.landing import publish
from kelda.sources.scratch import scratch_path

GRAINS = ("year", "quarter", "month", "week", "day", "hour")


def summarize(
    fact: DataFrame, grain: tuple[str, str], dims: Sequence[str], measures: dict[str, Column]
) -> DataFrame:
    """Aggregates per period and dimensions; ``grain`` is (unit, time column)."""
    unit, ts = grain
    if unit not in GRAINS:
        raise ValueError(f"unknown grain {unit!r}, use one of {', '.join(GRAINS)}")
    period = F.date_trunc(unit, ts)
    if unit != "hour":
        period = F.to_date(period)
    return fact.groupBy(period.alias("period"), *dims).agg(
        *[agg.alias(name) for name, agg in measures.items()]
    )


def trailing(
    df: DataFrame, key: str, ts: str, days: Sequence[int], measures: dict[str, Column]
) -> DataFrame:
    """Sums over the last N days, today included, for each day an entity was active.

    ``measures`` are row-level values. They are summed per entity and day first: a window
    then holds one row per active day, however many rows the entity has.
    """
    daily = df.groupBy(key, F.to_date(ts).alias("day")).agg(
        *[F.sum(value).alias(f"_{name}") for name, value in measures.items()]
    )
    by_day = Window.partitionBy(key).orderBy(F.unix_date("day"))
    return daily.select(
        key,
        "day",
        *[
            F.sum(f"_{name}").over(by_day.rangeBetween(1 - n, 0)).alias(f"{name}_{n}d")
            for n in days
            for name in measures
        ],
    )


REDUCERS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def subtotals(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    measures: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Aggregates for each of the given column sets, with ``level_id`` telling them apart.

    ``measures`` are (sum | count | min | max, value). All of these can be combined from
    finer groups, so the rows are grouped once and only the groups are expanded.
    A 1 bit in ``level_id`` marks a column that was summed over; the first column has the
    highest bit.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    finest = df.groupBy(*columns).agg(
        *[first[kind](value).alias(name) for name, (kind, value) in measures.items()]
    )
    combined = {
        name: F.coalesce(F.sum(name), F.lit(0)) if kind == "count" else REDUCERS[kind](name)
        for name, (kind, _) in measures.items()
    }
    combined = [column.alias(name) for name, column in combined.items()]
    some = [[F.col(c) for c in s] for s in sets if s]
    parts = []
    if some:
        level = F.grouping_id().cast("int").alias("level_id")
        parts.append(finest.groupingSets(some, *columns).agg(level, *combined))
    if len(some) < len(sets):
        # The grand total is an aggregate of its own: it has its row even if the table has none.
        blanks = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in columns]
        level = F.lit(2 ** len(columns) - 1).alias("level_id")
        total = finest.agg(*combined).select(*blanks, level, *measures)
        parts += [total] * (len(sets) - len(some))
    return reduce(DataFrame.unionByName, parts)


def cube_sets(columns: Sequence[str]) -> list[list[str]]:
    """All subsets of the columns."""
    sets: list[list[str]] = [[]]
    for column in columns:
        sets += [[*s, column] for s in sets]
    return sets


def rollup_sets(columns: Sequence[str]) -> list[list[str]]:
    """All prefixes of the columns."""
    return [list(columns[:n]) for n in range(len(columns), -1, -1)]


def period_compare(
    df: DataFrame, period: str, key: str, measure: str, offsets: dict[str, int] | None = None
) -> DataFrame:
    """A monthly measure beside its value some months before; a missing month gives null.

    ``df`` has one row per key and month (a date). Each row is sent forward to the months
    that compare with it and one grouping brings them together, so ``df`` is computed once
    where a self-join would compute it for each offset.
    """
    offsets = offsets or {"prev_month": 1, "last_year": 12}
    steps = F.array(*[F.lit(n) for n in (0, *offsets.values())])
    sent = df.select(key, period, F.col(measure).alias("_value"), F.explode(steps).alias("_back"))
    sent = sent.withColumn(period, F.add_months(period, F.col("_back")))
    at = lambda n: F.max(F.when(F.col("_back") == n, F.col("_value")))
    together = (
        sent.groupBy(key, period)
        .agg(
            F.max(F.col("_back") == 0).alias("_present"),
            at(0).alias(measure),
            *[at(n).alias(name) for name, n in offsets.items()],
        )
        .where("_present")
    )
    changes = [(F.col(measure) - F.col(name)).alias(f"{name}_change") for name in offsets]
    return together.select(key, period, measure, *offsets, *changes)


def running_share(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    measure: str,
    chunk: Column,
    busy: int = BUSY,
) -> DataFrame:
    """Running total and share of the group's total; ``order`` must be total.

    A group with more than ``busy`` rows is worked through in chunks. ``chunk`` must never
    fall as ``order`` rises, e.g. the day of a leading date.
    """
    chunked = chunk_busy(df, [group], chunk, busy)
    summed = running_sum(chunked, [group], order, measure, "running_total", "group_total")
    share = F.col(measure).cast("double") / F.nullif(F.col("group_total").cast("double"), F.lit(0.0))
    running = F.col("running_total").cast("double") / F.nullif(
        F.col("group_total").cast("double"), F.lit(0.0)
    )
    return summed.withColumns({"share": share, "running_share": running}).drop(CHUNK)


def top_k(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, ties: str = "row_number"
) -> DataFrame:
    """The first k per group. ``ties``: row_number (k rows, ``order`` total), rank or dense_rank.

    A limit on a rank is also applied before the shuffle, so a large group sends only its
    candidates.
    """
    place = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[ties]
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("place", place().over(window)).where(F.col("place") <= k)


def pivot(
    df: DataFrame, group: Sequence[str], column: str, values: Sequence, agg: Column
) -> DataFrame:
    """One column per listed value; the list is fixed, so no query has to find it."""
    return df.groupBy(*group).pivot(column, list(values)).agg(agg)


def unpivot(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str
) -> DataFrame:
    """The listed columns as rows of (name, value)."""
    return df.unpivot(list(ids), list(values), name, value)


def percentiles(
    df: DataFrame,
    group: str,
    col: str,
    ps: Sequence[float],
    exact: bool = True,
    buckets: int = 1024,
    task_rows: int = 1_000_000,
) -> DataFrame:
    """Percentiles per group as one row per (group, p); exact ones interpolate linearly.

    The built-in exact ``percentile`` keeps all distinct values of a group in one task's
    memory. Here a group's value range is cut into equal cells; their row counts tell which
    cells hold the wanted positions, and only those are looked into further. A cell with more than
    ``task_rows`` rows is cut again, so heavy tails do not end up in one task either. Only
    then are values ordered, cell by cell. Cells are written out between the steps, so Spark
    knows their size and broadcasts them only if small. The approximate form is a sketch of
    bounded size.
    """
    if not exact:
        sketch = df.groupBy(group).agg(
            F.percentile_approx(col, [float(p) for p in ps], 10000).alias("_v")
        )
        wanted = F.arrays_zip(F.array(*[F.lit(float(p)) for p in ps]).alias("p"), F.col("_v").alias("v"))
        return sketch.select(group, F.explode(wanted).alias("_z")).select(
            group, F.col("_z.p").alias("p"), F.col("_z.v").alias("value")
        )
    store = lambda frame: publish(frame, scratch_path(df.sparkSession, "cells"))
    rows = df.where(F.col(col).isNotNull()).select(
        group, F.col(col).alias("_value"), F.lit(0).cast("bigint").alias("_cell")
    )
    in_cell = [
        F.count("*").alias("_in"),
        F.min("_value").alias("_lo"),
        F.max("_value").alias("_hi"),
    ]
    spot = (F.col("_in") - 1) * F.col("p")
    # A position between two rows needs both; positions count from 0 within the cell.
    ends = F.array(
        F.struct(F.lit("low").alias("end"), F.floor(spot).alias("place")),
        F.struct(F.lit("high").alias("end"), F.ceil(spot).alias("place")),
    )
    wanted = (
        store(rows.groupBy(group, "_cell").agg(*in_cell))
        .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in ps])))
        .select("*", (spot - F.floor(spot)).alias("part"), F.explode(ends).alias("e"))
        .select(group, "_cell", "_in", "_lo", "_hi", "p", "part", "e.*")
    )
    before = F.sum("_in").over(
        Window.partitionBy(group, "_cell").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
    )
    # Each round divides by the number of cells; the numbering has room for five.
    for _ in range(5):
        largest = wanted.where("_lo < _hi").agg(F.max("_in")).first()[0]
        if (largest or 0) <= task_rows:
            break
        cells = wanted.select(group, "_cell", "_lo", "_hi").distinct()
        place = bucket_of(F.col("_value"), F.col("_lo"), F.col("_hi"), buckets)
        cut = rows.join(cells, [group, "_cell"]).select(
            group, "_value", "_cell", (F.col("_cell") * buckets + place).alias("_next")
        )
        counted = cut.groupBy(group, "_cell", "_next").agg(*in_cell)
        counted = counted.withColumn("_before", F.coalesce(before, F.lit(0)))
        inside = F.col("place").between(F.col("_before"), F.col("_before") + F.col("_in") - 1)
        wanted = store(
            wanted.drop("_in", "_lo", "_hi")
            .join(counted, [group, "_cell"])
            .where(inside)
            .withColumns({"place": F.col("place") - F.col("_before"), "_cell": F.col("_next")})
            .drop("_before", "_next")
        )
        rows = cut.select(group, "_value", F.col("_next").alias("_cell"))
    upto = F.sum("_n").over(
        Window.partitionBy(group, "_cell")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    values = (
        rows.join(wanted.select(group, "_cell").distinct(), [group, "_cell"], "left_semi")
        .groupBy(group, "_cell", "_value")
        .agg(F.count("*").alias("_n"))
        .withColumn("_end", upto)
    )
    at = F.col("place").between(F.col("_end") - F.col("_n"), F.col("_end") - 1)
    side = lambda name: F.max(F.when(F.col("end") == name, F.col("_value").cast("double")))
    found = (
        values.join(wanted, [group, "_cell"])
        .where(at)
        .groupBy(group, "p", "part")
        .agg(side("low").alias("_low"), side("high").alias("_high"))
    )
    return found.select(
        group, "p", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("part")).alias("value")
    )


def distinct_sketch(df: DataFrame, group: Sequence[str], id: str, lg_k: int = 12) -> DataFrame:
    """A small mergeable sketch of the distinct ids per group."""
    return df.groupBy(*group).agg(F.hll_sketch_agg(id, lg_k).alias("sketch"))


def merge_sketches(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """Approximate distinct ids of coarser groups, from stored sketches alone."""
    return sketches.groupBy(*group).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct")
    )


def distinct_bitmap(df: DataFrame, group: Sequence[str], id: str) -> DataFrame:
    """The distinct integer ids per group as bitmaps of bounded size."""
    return df.groupBy(*group, F.bitmap_bucket_number(id).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id)).alias("bitmap")
    )


def merge_bitmaps(bitmaps: DataFrame, group: Sequence[str]) -> DataFrame:
    """Exact distinct ids of coarser groups, from stored bitmaps alone."""
    merged = bitmaps.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*group).agg(F.sum(F.bitmap_count("bitmap")).alias("n_distinct"))
