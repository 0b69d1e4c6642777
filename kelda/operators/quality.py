"""Data-quality checks; each returns (table, rule, bad_rows, total_rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelda.functions.ordered import fill_days


def _result(df: DataFrame, table: str, rule: str, bad: Column, total: Column) -> DataFrame:
    return df.agg(
        F.lit(table).alias("table"),
        F.lit(rule).alias("rule"),
        F.coalesce(bad, F.lit(0)).cast("bigint").alias("bad_rows"),
        F.coalesce(total, F.lit(0)).cast("bigint").alias("total_rows"),
    )


def check_unique(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Bad rows are those that share their key with another row."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    rule = f"unique({','.join(keys)})"
    shared = F.sum(F.when(F.col("n") > 1, F.col("n")))
    return _result(per_key, table, rule, shared, F.sum("n"))


def check_rules(df: DataFrame, rules: dict[str, Column], table: str) -> DataFrame:
    """Any number of row rules in one pass; a rule is true for good rows, null counts as bad."""
    counted = df.agg(
        F.count("*").alias("total_rows"),
        *[
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"rule_{i}")
            for i, rule in enumerate(rules.values())
        ],
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"rule_{i}").alias("bad_rows"))
            for i, name in enumerate(rules)
        ]
    )
    return counted.select(F.explode(rows).alias("r"), "total_rows").select(
        F.lit(table).alias("table"), "r.rule", "r.bad_rows", "total_rows"
    )


def check_fk(
    child: DataFrame, parent: DataFrame, on: tuple[str, str], table: str
) -> DataFrame:
    """Child rows whose key the parent lacks; a null key refers to nothing and is not bad.

    Child rows are counted per key before the join, so it moves keys rather than rows.
    """
    child_key, parent_key = on
    per_key = child.groupBy(F.col(child_key).alias("_key")).agg(F.count("*").alias("_n"))
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    joined = per_key.join(known, F.col("_key") == F.col("_parent"), "left")
    orphan = F.col("_key").isNotNull() & F.col("_parent").isNull()
    rule = f"fk({child_key}->{parent_key})"
    return _result(joined, table, rule, F.sum(F.when(orphan, F.col("_n"))), F.sum("_n"))


def reconcile(a: DataFrame, b: DataFrame, measures: dict[str, tuple[Column, Column]], table: str) -> DataFrame:
    """Do two layers agree on row count and sums? One row per measure.

    ``measures`` maps a name to its value in ``a`` and in ``b``. ``bad_rows`` is 1 where
    the layers differ, ``total_rows`` the row count of ``a``.
    """

    def totals(df: DataFrame, side: int) -> DataFrame:
        return df.agg(
            F.lit(side).alias("side"),
            F.count("*").alias("n"),
            *[F.sum(pair[side]).alias(name) for name, pair in measures.items()],
        )

    both = totals(a, 0).unionByName(totals(b, 1))
    at = lambda name, side: F.max(F.when(F.col("side") == side, F.col(name)))
    verdicts = both.agg(
        at("n", 0).alias("total_rows"),
        *[
            F.when(at(name, 0).eqNullSafe(at(name, 1)), 0).otherwise(1).alias(f"bad_{name}")
            for name in ("n", *measures)
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit("row count" if name == "n" else f"sum({name})").alias("rule"),
                F.col(f"bad_{name}").cast("bigint").alias("bad_rows"),
            )
            for name in ("n", *measures)
        ]
    )
    return verdicts.select(F.explode(rows).alias("r"), "total_rows").select(
        F.lit(table).alias("table"), "r.rule", "r.bad_rows", "total_rows"
    )


def daily_volume(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows per calendar day with mean and deviation over the ``days`` days before it.

    Days without rows count as zero. After the grouping there is one row per day, which is
    why a single window over all of them is harmless.
    """
    daily = df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("_n"))
    return _with_trailing(daily, days)


def _with_trailing(daily: DataFrame, days: int) -> DataFrame:
    """The table of (day, _n) with a row for every day and the figures before it."""
    filled = fill_days(daily).select("day", F.coalesce("_n", F.lit(0)).alias("n"))
    before = Window.orderBy("day").rowsBetween(-days, -1)
    counted = filled.select(
        "day",
        "n",
        F.count("n").over(before).alias("_days"),
        F.sum("n").over(before).alias("_sum"),
        F.sum(F.col("n").cast("decimal(19,0)") * F.col("n")).over(before).alias("_squares"),
    )
    d, total = F.col("_days"), F.col("_sum")
    # Integer sums: the same result in any order of addition.
    spread = d * F.col("_squares") - total.cast("decimal(19,0)") * total
    return counted.select(
        "day",
        "n",
        F.col("_days").alias("days_before"),
        F.when(d > 0, total.cast("double") / d).alias("trailing_mean"),
        F.when(d > 1, F.sqrt(spread.cast("double") / (d * (d - 1)))).alias("trailing_sd"),
    )


def volume_outliers(daily: DataFrame, days: int, z: float) -> DataFrame:
    """Add ``is_bad``: a full history of ``days`` days, and more than z deviations off."""
    off = F.abs(F.col("n") - F.col("trailing_mean")) > F.col("trailing_sd") * z
    return daily.withColumn(
        "is_bad", F.coalesce((F.col("days_before") == days) & off, F.lit(False))
    )


def check_volume(df: DataFrame, ts: str, days: int, z: float, table: str) -> DataFrame:
    """Bad rows are the rows of days whose volume is far from the trailing mean, and under a rule
    of their own the rows without a time; both count in the total."""
    daily = df.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("_n"))
    marked = volume_outliers(_with_trailing(daily.where(F.col("day").isNotNull()), days), days, z)
    untimed = daily.where(F.col("day").isNull()).select(F.col("_n").alias("_untimed"))
    every = marked.select("n", "is_bad", F.lit(0).cast("bigint").alias("_untimed")).unionByName(
        untimed.select(F.lit(0).cast("bigint").alias("n"), F.lit(False).alias("is_bad"), "_untimed")
    )
    total = F.sum(F.col("n") + F.col("_untimed"))
    counts = every.agg(
        total.alias("total"), F.sum(F.when(F.col("is_bad"), F.col("n"))).alias("off"), F.sum("_untimed").alias("untimed")
    )
    rules = F.array(
        F.struct(F.lit(f"volume({days}d)").alias("rule"), F.col("off").alias("bad")),
        F.struct(F.lit(f"has {ts}").alias("rule"), F.col("untimed").alias("bad")),
    )
    return counts.select(F.explode(rules).alias("r"), "total").select(
        F.lit(table).alias("table"),
        "r.rule",
        F.coalesce("r.bad", F.lit(0)).cast("bigint").alias("bad_rows"),
        F.coalesce("total", F.lit(0)).cast("bigint").alias("total_rows"),
    )
