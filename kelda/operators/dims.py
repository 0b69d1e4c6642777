"""Dimensions: calendars, flattened hierarchies, surrogate keys, history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kelda.functions.keys import key_hash
from kelda.functions.ordered import BUSY, CHUNK, as_of, chunk_time, is_chunked, match, ordered
from kelda.sources.landing import publish
from kelda.sources.scratch import scratch_path

OPEN_END = datetime(9999, 12, 31)


def calendar(span: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day for each row's span of days, both ends included."""
    days = span.select(F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("day"))
    return days.select(
        "day",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        F.weekofyear("day").alias("iso_week"),
        # Monday = 1; the engines' own weekday numbers differ.
        (F.weekday("day") + 1).alias("iso_weekday"),
        (F.weekday("day") >= 5).alias("is_weekend"),
    )


def date_dim(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end`` with its calendar attributes."""
    span = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar(span, "start", "end")


def flatten_dim(base: DataFrame, *parents: tuple[DataFrame, str, str]) -> DataFrame:
    """Follow a hierarchy upwards; a parent is (table, key in the child, key in the parent).

    Plain left joins without a hint: Spark broadcasts a parent whose measured size is
    below its threshold and otherwise shuffles, with skewed child keys split.
    """
    for parent, child_key, parent_key in parents:
        base = base.join(parent, F.col(child_key) == F.col(parent_key), "left")
    return base


def surrogate_key(df: DataFrame, keys: Sequence[str], out: str = "sk") -> DataFrame:
    """A key that depends on the natural key alone, so every run and machine agrees."""
    return df.withColumn(out, key_hash(keys))


def scd2_build(
    changes: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts: str,
    tie: str,
    grain: str = "day",
    busy: int | None = BUSY,
) -> DataFrame:
    """History from a change log: half-open intervals, changes that change nothing dropped.

    Of changes at the same instant the one with the highest ``tie`` counts.
    """
    settled = chunk_time(
        changes.groupBy(F.col(key), F.col(ts).alias("valid_from")).agg(
            F.max_by(F.struct(*attrs), tie).alias("_attrs")
        ),
        [key],
        "valid_from",
        grain,
        busy,
    )
    order = ordered(settled, [key], ["valid_from"])
    # Every row but a chunk's first knows whether it changes anything.
    local = settled.withColumn("_head", F.row_number().over(order) == 1).withColumn(
        "_moved", ~F.col("_attrs").eqNullSafe(F.lag("_attrs").over(order)) & ~F.col("_head")
    )
    if is_chunked(settled):
        local = match(local, _chunk_heads(local, key), [key, CHUNK])
    else:
        local = local.withColumns({"_head_moved": F.lit(True), "_next_change": F.lit(None)})
    # The first chunk of a key, and the only one of most, starts with a change.
    head_moved = F.coalesce("_head_moved", F.lit(True))
    changed = local.where((F.col("_head") & head_moved) | F.col("_moved"))
    end = F.lit(OPEN_END).cast(changes.schema[ts].dataType)
    return changed.select(
        key,
        "_attrs.*",
        "valid_from",
        F.coalesce(F.lead("valid_from").over(order), "_next_change", end).alias("valid_to"),
    )


def _chunk_heads(local: DataFrame, key: str) -> DataFrame:
    """Per chunk: does its first row change anything, and when is the first change after it?"""
    by_key = Window.partitionBy(key).orderBy(CHUNK)
    follows = F.lag(F.lit(True)).over(by_key).isNotNull()
    same = F.col("_head_attrs").eqNullSafe(F.lag("_last_attrs").over(by_key))
    change = F.when(F.col("_head_moved"), F.col("_first")).otherwise(F.col("_first_moved"))
    later = by_key.rowsBetween(1, Window.unboundedFollowing)
    return (
        local.where(F.col(CHUNK).isNotNull())
        .groupBy(key, CHUNK)
        .agg(
            F.min("valid_from").alias("_first"),
            # In a struct, a missing time is the earliest and not left out.
            F.min_by("_attrs", F.struct("valid_from")).alias("_head_attrs"),
            F.max_by("_attrs", F.struct("valid_from")).alias("_last_attrs"),
            F.min(F.when(F.col("_moved"), F.col("valid_from"))).alias("_first_moved"),
        )
        .withColumn("_head_moved", ~(follows & same))
        .withColumn("_change", change)
        .select(
            key,
            CHUNK,
            "_head_moved",
            F.first("_change", ignorenulls=True).over(later).alias("_next_change"),
        )
    )


def scd2_merge(
    dim: DataFrame,
    log: DataFrame,
    changes: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts: str,
    tie: str,
    grain: str = "day",
    busy: int | None = BUSY,
) -> DataFrame:
    """History after a further batch of changes, late ones included.

    Touched keys are rebuilt from the change log (``log`` is the one without this batch):
    stored history has lost the no-op changes a late row can bring back to life.
    """
    # Stored, so that the joins below can be broadcast or split by its measured size.
    touched = publish(
        changes.select(key).distinct(), scratch_path(changes.sparkSession, "touched")
    )
    columns = [key, *attrs, ts, tie]
    replay = log.join(touched, key, "left_semi").select(columns)
    rebuilt = scd2_build(
        replay.unionByName(changes.select(columns)), key, attrs, ts, tie, grain, busy
    )
    return dim.join(touched, key, "left_anti").select(rebuilt.columns).unionByName(rebuilt)


def dim_as_of(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    dim_key: str | None = None,
    grain: str = "day",
    busy: int | None = BUSY,
) -> DataFrame:
    """Attach the version valid at the fact's time; facts without one keep nulls.

    A join on key and range would look at every version of a key for each of its facts.
    Versions of a key do not overlap, so the latest one to start is the only candidate:
    one ordered pass over facts and versions together finds it.
    """
    dim_key = dim_key or key
    payload = [c for c in dim.columns if c != dim_key]
    found = as_of(fact, dim, (key, dim_key), (ts, "valid_from"), payload, "_known", grain, busy=busy)
    valid = F.col(ts) < F.col("_known.valid_to")
    return found.select(
        *fact.columns, *[F.when(valid, F.col(f"_known.`{c}`")).alias(c) for c in payload]
    )


def unknown_member(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, default: int = -1
) -> DataFrame:
    """Point facts whose key the dimension lacks to the default member.

    The original key stays in ``<key>_source`` and ``is_unknown`` marks the rows.
    """
    dim_key = dim_key or key
    known = publish(
        dim.select(F.col(dim_key).alias("_known")).distinct(), scratch_path(dim.sparkSession, "known")
    )
    return (
        fact.join(known, F.col(key) == F.col("_known"), "left")
        .withColumn(f"{key}_source", F.col(key))
        .withColumn(key, F.coalesce("_known", F.lit(default).cast(fact.schema[key].dataType)))
        .withColumn("is_unknown", F.col("_known").isNull())
        .drop("_known")
    )


def count_unknown(resolved: DataFrame) -> DataFrame:
    """How many facts the default member stands in for."""
    return resolved.agg(
        F.count("*").alias("total_rows"), F.count_if("is_unknown").alias("unknown_rows")
    )
