"""Per-key ordered computations that no single key can overload.

A window over ``partitionBy(key)`` puts all rows of a key into one task, which fails when
one key owns a third of the table. So keys are counted first, and the rows of those with
more than ``busy`` rows are cut into chunks of time: each (key, chunk) is a window partition
of its own, and what a chunk needs to know about its predecessors is carried over from one
summary row per chunk. All other keys go through the plain window. If no key is busy, the
plan is the plain window and nothing else.

The busy keys are at most rows / ``busy`` in number and are written out before use, so that
Spark knows their size and broadcasts them only if small. Choose the grain so that the
busiest key's chunk fits one task. A null key is a key. Rows with a null time come before all
others of their key, in a chunk of their own if the key is busy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kelda.sources.landing import publish
from kelda.sources.scratch import scratch_path

CHUNK = "_chunk"
# Rows of one key a task sorts with ease.
BUSY = 1_000_000


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys where null equals null; the result has the left side's key columns."""
    names = [f"_match_{i}" for i, _ in enumerate(keys)]
    renamed = right.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in right.columns if c not in keys]
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return left.join(renamed, same, how).drop(*names)


def chunk_busy(
    df: DataFrame, keys: Sequence[str], chunk: Column, busy: int | None = BUSY
) -> DataFrame:
    """Add the chunk column if any key has more than ``busy`` rows; null for all other keys.

    ``chunk`` must never fall as a key's order rises. With ``busy`` None no key is counted or cut:
    for inputs that are known to be small.
    """
    if busy is None:
        return df
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > busy)
    hot = publish(
        counted.select(*keys, F.lit(True).alias("_busy")), scratch_path(df.sparkSession, "busy")
    )
    if hot.isEmpty():
        return df
    marked = match(df, hot, keys)
    # In a struct, a missing time is a chunk too, and the first one.
    return marked.withColumn(CHUNK, F.when(F.col("_busy"), F.struct(chunk.alias("at")))).drop("_busy")


def chunk_time(
    df: DataFrame, keys: Sequence[str], ts: str, grain: str, busy: int | None = BUSY
) -> DataFrame:
    """Chunk busy keys by a ``date_trunc`` unit of their time column."""
    chunk = F.date_trunc(grain, F.col(ts))
    return chunk_busy(df, keys, chunk, busy)


def is_chunked(df: DataFrame) -> bool:
    return CHUNK in df.columns


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """Window by key, and by chunk where there are chunks."""
    chunk = [CHUNK] if is_chunked(df) else []
    return Window.partitionBy(*keys, *chunk).orderBy(*order)


def attach_carry(
    df: DataFrame,
    keys: Sequence[str],
    summary: dict[str, Column],
    carries: dict[str, Callable[[WindowSpec], Column]],
) -> DataFrame:
    """Add to each row what its chunk takes over from the key's other chunks; null if nothing.

    ``summary`` are aggregates per (key, chunk), ``carries`` are expressions over those
    aggregates in a window by key in chunk order.
    """
    if not is_chunked(df):
        return df.withColumns({name: F.lit(None) for name in carries})
    per_chunk = (
        df.where(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(*[agg.alias(name) for name, agg in summary.items()])
    )
    by_key = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = per_chunk.select(
        *keys, CHUNK, *[make(by_key).alias(name) for name, make in carries.items()]
    )
    return match(df, carried, [*keys, CHUNK])


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """The latest non-null ``value`` up to and including each row."""
    edge = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    before = (Window.unboundedPreceding, -1)
    carried = attach_carry(
        df,
        keys,
        {"_edge": edge},
        {"_carry": lambda w: F.last("_edge", ignorenulls=True).over(w.rowsBetween(*before))},
    )
    so_far = ordered(df, keys, order).rowsBetween(Window.unboundedPreceding, 0)
    within = F.last(value, ignorenulls=True).over(so_far)
    return carried.withColumn(out, F.coalesce(within, "_carry")).drop("_carry")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    total: str | None = None,
) -> DataFrame:
    """Sum of ``value`` up to each row of its key, and on request the key's total."""
    sums = {"_sum": F.sum(value)}
    carries = {
        "_carry": lambda w: F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "_total": lambda w: F.sum("_sum").over(
            w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ),
    }
    carried = attach_carry(df, keys, sums, carries)
    by_order = ordered(df, keys, order)
    within = F.sum(value).over(by_order.rowsBetween(Window.unboundedPreceding, 0))
    # A side without non-null values adds nothing; both sides empty stays null.
    added = {out: F.coalesce(within + F.col("_carry"), within, F.col("_carry"))}
    if total:
        everything = by_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        added[total] = F.coalesce("_total", F.sum(value).over(everything))
    return carried.withColumns(added).drop("_carry", "_total")


def bucket_of(value: Column, low: Column, high: Column, buckets: int) -> Column:
    """Number of the equal-width bucket of ``value``; never falls as ``value`` rises.

    Depends only on exact minimum and maximum, so a recomputed task gives the same answer.
    """
    low = low.cast("double")
    width = (high.cast("double") - low) / F.lit(float(buckets))
    place = F.floor((value.cast("double") - low) / F.nullif(width, F.lit(0.0)))
    return F.coalesce(F.least(place, F.lit(buckets - 1)), F.lit(0)).cast("int")


def sorted_ranks(df: DataFrame, order: Sequence[str], out: str, pieces: int | None = None) -> DataFrame:
    """Rows with their position, from 1, in the order of the columns ``order`` (nulls first).

    Columns of any type with an order will do, also several. A sample sort: Spark samples the
    columns for splitters and deals the rows to ranges (``pieces`` of them, or as many as its
    shuffles have), each range is sorted by a task, and what is summed up in order are the
    ranges' numbers of rows. The order must be total, or which of equal rows comes first is not
    defined; equal rows are one range's.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(pieces, *order) if pieces else df.repartitionByRange(*order)
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = publish(
        ranges.sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_nth": within}),
        scratch_path(spark, "ranges"),
    )
    # One row for each range.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("_part", F.coalesce(upto, F.lit(0)).alias("_before"))
    before = publish(before, scratch_path(spark, "range-starts"))
    place = F.col("_before") + F.col("_nth") + 1
    return placed.join(before, "_part").withColumn(out, place).drop("_part", "_nth", "_before")


def tile_of(rank: Column, rows: Column, tiles: int) -> Column:
    """``ntile(tiles)`` from a position and the number of rows."""
    small = F.floor(rows / tiles)
    extra = rows % tiles
    in_large = extra * (small + 1)
    return (
        F.when(rank <= in_large, F.ceil(rank / (small + 1)))
        .otherwise(extra + F.ceil((rank - in_large) / F.greatest(small, F.lit(1))))
        .cast("int")
    )


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: tuple[str, str],
    times: tuple[str, str],
    payload: Sequence[str],
    out: str,
    grain: str,
    tie: str | None = None,
    busy: int | None = BUSY,
) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time, as a struct.

    Both sides are stacked and read once in time order, so the work is linear where a join
    on key and range would pair every left row with all right rows of its key. ``tie``
    picks among right rows of the same instant: the highest counts.
    """
    tie_of = F.col(tie) if tie else F.lit(None).cast("bigint")
    source = right.select(
        F.col(keys[1]).alias("_key"),
        F.col(times[1]).alias("_at"),
        F.lit(0).alias("_side"),
        tie_of.alias("_tie"),
        F.struct(*payload).alias("_payload"),
    )
    target = left.select(
        F.col(keys[0]).alias("_key"),
        F.col(times[0]).alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_row"),
    )
    both = source.unionByName(target, allowMissingColumns=True)
    if busy is not None:
        # Counting the keys must not run whatever made the two sides a second time.
        both = publish(both, scratch_path(left.sparkSession, "as-of"))
    both = chunk_time(both, ["_key"], "_at", grain, busy)
    known = last_known(both, ["_key"], ["_at", "_side", "_tie"], "_payload", out)
    return known.where("_side = 1").select("_row.*", out)


def fill_days(daily: DataFrame, day: str = "day") -> DataFrame:
    """Add the calendar days missing between a table's days; their other columns are null.

    ``daily`` has one row per day, so a single window over all of it stays small.
    """
    rest = [c for c in daily.columns if c != day]
    until = F.date_sub(F.lead(day).over(Window.orderBy(day)), 1)
    days = F.sequence(F.col(day), F.coalesce("_until", day))
    spread = daily.withColumn("_until", until).select("*", F.posexplode(days).alias("_place", "_day"))
    return spread.select(
        F.col("_day").alias(day), *[F.when(F.col("_place") == 0, F.col(c)).alias(c) for c in rest]
    )
