"""Facts: wide lines, periodic and accumulating snapshots, coverage, allocation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelda.functions.ordered import BUSY, match
from kelda.functions.times import month_start
from kelda.sources.landing import publish
from kelda.sources.scratch import scratch_path


def wide_fact(
    lines: DataFrame,
    orders: DataFrame,
    *dims: tuple[DataFrame, str, str],
    on: tuple[str, str] = ("l_orderkey", "o_orderkey"),
) -> DataFrame:
    """Lines with their order and dimension columns; a dimension is (table, fact key, key).

    Left joins: a line without order keeps nulls, the order's key among them, and a missing
    member loses no line. Spark broadcasts the sides it measures as small.
    """
    fact = lines.join(orders, F.col(on[0]) == F.col(on[1]), "left")
    for dim, fact_key, dim_key in dims:
        fact = fact.join(dim, F.col(fact_key) == F.col(dim_key), "left")
    return fact


def periodic_snapshot(
    fact: DataFrame,
    entities: DataFrame,
    months: tuple[Column, Column],
    key: str,
    entity_key: str,
    ts: str,
    measure: Column,
) -> DataFrame:
    """One row per entity and month, months without activity included, with a running balance.

    ``months`` are the first day of the first and of the last month. Facts are summed per entity and month first, so each entity's window holds one row per
    month. Calendar rows are generated next to each entity instead of cross-joined. Activity before
    the first month counts towards the balance; activity after the last does not appear.
    """
    monthly = fact.groupBy(F.col(key).alias(entity_key), month_start(ts).alias("_month")).agg(
        F.count("*").alias("_n"), F.sum(measure).alias("_amount")
    )
    first, last = months
    calendar = F.sequence(first, last, F.expr("interval 1 month"))
    grid = entities.select(entity_key, F.explode(calendar).alias("month"))
    # Earlier activity is moved to the first month as an opening amount.
    inside = F.col("_month") >= first
    placed = monthly.groupBy(entity_key, F.greatest("_month", first).alias("month")).agg(
        F.sum(F.when(inside, F.col("_n"))).alias("_n"),
        F.sum(F.when(inside, F.col("_amount"))).alias("_amount"),
        F.sum("_amount").alias("_with_opening"),
    )
    filled = grid.join(placed, [entity_key, "month"], "left")
    so_far = Window.partitionBy(entity_key).orderBy("month").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return filled.select(
        entity_key,
        "month",
        F.coalesce("_n", F.lit(0)).alias("n"),
        F.coalesce("_amount", F.lit(0)).alias("amount"),
        F.coalesce(F.sum("_with_opening").over(so_far), F.lit(0)).alias("balance"),
    )


def milestones(
    orders: DataFrame,
    lines: DataFrame,
    on: tuple[str, str] = ("o_orderkey", "l_orderkey"),
    opened: str = "o_orderdate",
    shipped: str = "l_shipdate",
) -> DataFrame:
    """One row per order with its milestone times and the days between them.

    Lags are as the data has them, negative ones included.
    """
    per_order = lines.groupBy(F.col(on[1]).alias("_order")).agg(
        F.min(shipped).alias("first_ship"),
        F.max(shipped).alias("last_ship"),
        F.count("*").alias("n_lines"),
    )
    return orders.join(per_order, F.col(on[0]) == F.col("_order"), "left").select(
        on[0],
        opened,
        "first_ship",
        "last_ship",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.datediff("first_ship", opened).alias("days_to_first_ship"),
        F.datediff("last_ship", opened).alias("days_to_last_ship"),
        F.datediff("last_ship", "first_ship").alias("days_shipping"),
    )


def coverage_gap(expected: DataFrame, fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected combinations that did not occur."""
    return expected.join(fact.select(*keys).distinct(), list(keys), "left_anti")


def allocate(
    lines: DataFrame,
    amount: str,
    weight: str,
    order: Sequence[str],
    keys: Sequence[str] = ("l_orderkey",),
    out: str = "allocated",
    amounts: DataFrame | None = None,
    busy: int = BUSY,
) -> DataFrame:
    """Split an order-level amount over its lines by weight; cents left go to the last line.

    ``amount`` and ``weight`` are decimals with two places, ``order`` a total order of an
    order's lines. ``amount`` is a column of ``amounts``, which has one row per order and the
    same keys, or else of ``lines``, with the same value on all lines of an order. A line's
    share is cut to the cent. With a total weight of zero the last line takes the whole amount.

    A line whose order has no amount keeps a null share.

    Ordinary orders are one window each. Orders with more than ``busy`` lines would be too much
    for a task: their lines are joined to stored tables with one row per order, joins Spark can
    broadcast or split.
    """
    keys = list(keys)
    cents = lambda c: (F.col(c) * 100).cast("decimal(18,0)")
    weighed = lines.withColumn("_weight", cents(weight))
    if amounts is None:
        weighed = weighed.withColumn("_amount", cents(amount))
    else:
        weighed = match(weighed, amounts.select(*keys, cents(amount).alias("_amount")), keys)
    counted = lines.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > busy)
    hot = publish(counted.select(*keys), scratch_path(lines.sparkSession, "busy-orders"))
    if hot.isEmpty():
        shared = _share_in_windows(weighed, keys, order)
    else:
        few = match(weighed, hot, keys, "left_anti")
        many = match(weighed, hot, keys, "left_semi")
        shared = _share_in_windows(few, keys, order).unionByName(_share_by_joins(many, keys, order))
    return shared.withColumn(out, (F.col("_cents") / 100).cast("decimal(18,2)")).select(*lines.columns, out)


# Whole cents and whole-number division: no rounding to depend on.
SHARE = "CASE WHEN _amount IS NOT NULL THEN coalesce((_amount * _weight) div nullif(_total, 0), 0) END"


def _share_in_windows(weighed: DataFrame, keys: list[str], order: Sequence[str]) -> DataFrame:
    """Each line's ``_cents``; an order's lines pass through one window."""
    whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totalled = weighed.withColumns(
        {"_total": F.sum("_weight").over(whole), "_last": F.last(F.struct(*order)).over(whole)}
    )
    given = totalled.withColumn("_share", F.expr(SHARE)).withColumn("_given", F.sum("_share").over(whole))
    return _with_rest(given, order)


def _share_by_joins(weighed: DataFrame, keys: list[str], order: Sequence[str]) -> DataFrame:
    store = lambda frame: publish(frame, scratch_path(weighed.sparkSession, "allocation"))
    weighed = store(weighed)
    totals = store(
        weighed.groupBy(*keys).agg(F.sum("_weight").alias("_total"), F.max(F.struct(*order)).alias("_last"))
    )
    totalled = match(weighed, totals, keys).withColumn("_share", F.expr(SHARE))
    given = store(totalled.groupBy(*keys).agg(F.sum("_share").alias("_given")))
    return _with_rest(match(totalled, given, keys), order).select(
        *[c for c in weighed.columns], "_total", "_last", "_share", "_given", "_cents"
    )


def _with_rest(given: DataFrame, order: Sequence[str]) -> DataFrame:
    """The last line takes what the shares have left."""
    rest = F.when(F.struct(*order).eqNullSafe(F.col("_last")), F.col("_amount") - F.col("_given"))
    cents = F.col("_share") + F.when(F.col("_amount").isNotNull(), F.coalesce(rest, F.lit(0)))
    return given.withColumn("_cents", cents.cast("decimal(18,0)"))
