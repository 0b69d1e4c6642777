"""Deduplication and joins of streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelda.functions.times import micros, seconds
from kelda.operators.skew import SALT, with_salt, with_salts


def dedupe(df: DataFrame, id: str | Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of an id that arrive within ``delay`` of the first."""
    ids = [id] if isinstance(id, str) else list(id)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(ids)


def enrich(
    df: DataFrame, dim: DataFrame, on: tuple[str, str], hot: Sequence[int] = (), salts: int = 8
) -> DataFrame:
    """Add a static dimension's columns; events without a member keep nulls.

    A stream has no adaptive splitting of skewed joins. If the dimension is too large to be
    broadcast, give the hot keys of what has come so far (``skew.hot_keys``): their events are
    spread over ``salts`` tasks, and only their members are repeated.
    """
    if not hot:
        return df.join(dim, F.col(on[0]) == F.col(on[1]), "left")
    # Members are hashed as what they are compared with.
    kind = df.schema[on[0]].dataType
    left = with_salt(df, [on[0]], hot, salts, df.columns).withColumnRenamed(SALT, "_event_salt")
    right = with_salts(dim, [F.col(on[1]).cast(kind)], hot, salts)
    same = (F.col(on[0]) == F.col(on[1])) & (F.col("_event_salt") == F.col(SALT))
    return left.join(right, same, "left").drop("_event_salt", SALT)


def interval_join(
    a: DataFrame,
    b: DataFrame,
    key: tuple[str, str],
    times: tuple[str, str],
    lo: str,
    hi: str,
    delay: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs of the same key with ``a.ts + lo <= b.ts <= a.ts + hi``; inner or left outer.

    Rows also meet by time bucket, each ``b`` row in the one or two buckets its partners
    can be in. State and work of one busy key are thereby spread over many tasks. Columns
    of the two sides must differ in name.
    """
    low, high = seconds(lo) * 1_000_000, seconds(hi) * 1_000_000
    width = max(high - low, 60_000_000)
    a_ts, b_ts = times
    left = a.withWatermark(a_ts, delay).withColumn("_bucket", F.floor(micros(a_ts) / width))
    first = F.floor((micros(b_ts) - high) / width)
    last = F.floor((micros(b_ts) - low) / width)
    right = b.withWatermark(b_ts, delay).withColumn("_place", F.explode(F.sequence(first, last)))
    earliest = F.col(a_ts) + F.expr(f"interval {lo}")
    condition = (
        (F.col(key[0]) == F.col(key[1]))
        & (F.col("_bucket") == F.col("_place"))
        & (F.col(b_ts) >= earliest)
        & (F.col(b_ts) <= F.col(a_ts) + F.expr(f"interval {hi}"))
    )
    return left.join(right, condition, how).drop("_bucket", "_place")
