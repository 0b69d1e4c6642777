"""Aggregates over event-time windows.

All but sessions keep the ``window`` column, which ``rewindow`` needs; ``flat`` unpacks it.
Groups are pre-aggregated before the shuffle, so a busy group costs one row per task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelda.functions.times import seconds


def _named(measures: dict[str, Column]) -> list[Column]:
    return [agg.alias(name) for name, agg in measures.items()]


def tumbling(
    df: DataFrame,
    ts: str,
    size: str,
    delay: str,
    by: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Aggregates per window of ``size`` and group."""
    grouped = df.withWatermark(ts, delay).groupBy(F.window(ts, size), *by)
    return grouped.agg(*_named(measures or {"n": F.count("*")}))


def sliding(
    df: DataFrame,
    ts: str,
    size: str,
    step: str,
    delay: str,
    by: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
    merge: dict[str, Column] | None = None,
) -> DataFrame:
    """Aggregates per window of ``size`` that begins every ``step``.

    Rows are aggregated once, per pane: the longest span that both are multiples of. A window is made
    of its panes, so not rows but panes are in several windows. ``merge`` has for each measure how
    those of panes are put together, such as ``F.sum("n")`` for a count. A row is late once its pane is
    closed, ``delay`` after its end.
    """
    if measures and set(merge or ()) != set(measures):
        raise ValueError("merge must have the measures")
    pane = math.gcd(seconds(size), seconds(step))
    panes = tumbling(df, ts, f"{pane} seconds", delay, by, measures)
    grouped = panes.groupBy(F.window(F.window_time("window"), size, step), *by)
    return grouped.agg(*_named(merge or {"n": F.sum("n")}))


def sessions(
    df: DataFrame,
    key: str,
    ts: str,
    gap: str,
    delay: str,
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Aggregates per key and session; events exactly ``gap`` apart belong together.

    A window ends ``gap`` after its last event. Its bounds are taken from the events: Spark
    moves a filter on the bounds of ``session_window`` itself below the merging of sessions,
    where it removes events.
    """
    grouped = df.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), key)
    return grouped.agg(
        F.min(ts).alias("window_start"),
        (F.max(ts) + F.expr(f"interval {gap}")).alias("window_end"),
        *_named(measures or {"n": F.count("*")}),
    ).drop("session_window")


def rewindow(
    df: DataFrame, size: str, by: Sequence[str] = (), measures: dict[str, Column] | None = None
) -> DataFrame:
    """Aggregate windows into larger ones; ``df`` comes from ``tumbling``."""
    grouped = df.groupBy(F.window(F.window_time("window"), size), *by)
    return grouped.agg(*_named(measures or {"n": F.sum("n")}))


def flat(df: DataFrame) -> DataFrame:
    """``window`` as ``window_start`` and ``window_end``."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )
