import random
import statistics
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kelda.functions.ordered import fill_days, sorted_ranks, tile_of
from kelda.operators.facts import coverage_gap, milestones, periodic_snapshot, wide_fact
from kelda.operators.metrics import (
    cube_sets,
    distinct_bitmap,
    distinct_sketch,
    merge_bitmaps,
    merge_sketches,
    percentiles,
    period_compare,
    pivot,
    rollup_sets,
    subtotals,
    summarize,
    top_k,
    trailing,
    unpivot,
)


def test_wide_fact_keeps_lines_without_a_member(spark, rows):
    lines = spark.createDataFrame([(1, 7), (1, 8), (2, None)], "l_orderkey int, part int")
    orders = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "o_orderkey int, o string")
    parts = spark.createDataFrame([(7, "x")], "pk int, name string")
    fact = wide_fact(lines, orders, (parts, "part", "pk"))
    assert rows(fact, "l_orderkey", "part", "name") == [(1, 7, "x"), (1, 8, None), (2, None, None)]


def test_periodic_snapshot(spark, rows):
    facts = spark.createDataFrame(
        [(1, datetime(2023, 12, 5), 1), (1, datetime(2024, 2, 1), 10), (1, datetime(2024, 2, 9), 5), (1, datetime(2024, 9, 1), 99), (2, datetime(2023, 11, 1), 3)],
        "k int, ts timestamp_ntz, v int",
    )
    entities = spark.createDataFrame([(1,), (2,), (3,)], "e int")
    months = (F.lit(date(2024, 1, 1)), F.lit(date(2024, 3, 1)))
    got = periodic_snapshot(facts, entities, months, "k", "e", "ts", F.col("v"))
    jan, feb, mar = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
    assert rows(got, "e", "month", "n", "amount", "balance") == [
        (1, jan, 0, 0, 1),
        (1, feb, 2, 15, 16),
        (1, mar, 0, 0, 16),
        (2, jan, 0, 0, 3),
        (2, feb, 0, 0, 3),
        (2, mar, 0, 0, 3),
        (3, jan, 0, 0, 0),
        (3, feb, 0, 0, 0),
        (3, mar, 0, 0, 0),
    ]


def test_milestones(spark, rows):
    orders = spark.createDataFrame([(1, datetime(2024, 1, 10)), (2, datetime(2024, 1, 1))], "o_orderkey int, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame([(1, datetime(2024, 1, 8)), (1, datetime(2024, 1, 12))], "l_orderkey int, l_shipdate timestamp_ntz")
    got = milestones(orders, lines).select("o_orderkey", "n_lines", "days_to_first_ship", "days_to_last_ship", "days_shipping")
    assert rows(got) == [(1, 2, -2, 2, 4), (2, 0, None, None, None)]


def test_coverage_gap(spark, rows):
    expected = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, p string")
    fact = spark.createDataFrame([(1, "a")] * 3 + [(9, "z")], "k int, p string")
    assert rows(coverage_gap(expected, fact, ["k", "p"])) == [(1, "b"), (2, "a")]


def test_summarize_grains(spark, rows):
    fact = spark.createDataFrame([(datetime(2024, 5, 15, 13, 30), 2), (datetime(2024, 5, 16), 3)], "ts timestamp_ntz, v int")
    for grain, first in [("year", date(2024, 1, 1)), ("quarter", date(2024, 4, 1)), ("month", date(2024, 5, 1)), ("week", date(2024, 5, 13))]:
        assert rows(summarize(fact, (grain, "ts"), [], {"v": F.sum("v")})) == [(first, 5)]
    assert summarize(fact, ("hour", "ts"), [], {"v": F.sum("v")}).count() == 2
    with pytest.raises(ValueError):
        summarize(fact, ("fortnight", "ts"), [], {"v": F.sum("v")})


def test_trailing_includes_today(spark, rows):
    df = spark.createDataFrame([(1, datetime(2024, 1, d, h), 1) for d, h in [(1, 0), (1, 5), (7, 0), (8, 0)]], "k int, ts timestamp_ntz, v int")
    got = trailing(df, "k", "ts", [1, 7], {"v": F.col("v")})
    assert rows(got, F.dayofmonth("day"), "v_1d", "v_7d") == [(1, 2, 2), (7, 1, 3), (8, 1, 2)]


def test_wide_fact_keeps_lines_without_an_order(spark, rows):
    lines = spark.createDataFrame([(1, "a"), (9, "b"), (None, "c")], "l_orderkey int, x string")
    orders = spark.createDataFrame([(1, "o")], "o_orderkey int, y string")
    assert rows(wide_fact(lines, orders), "x", "o_orderkey") == [("a", 1), ("b", None), ("c", None)]


def test_subtotals_of_nothing(spark, rows):
    df = spark.createDataFrame([], "p string, q string, v int")
    measures = {"n": ("count", F.lit(1)), "s": ("sum", F.col("v"))}
    cube = subtotals(df, cube_sets(["p", "q"]), measures)
    assert rows(cube, "p", "q", "level_id", "n", "s") == [(None, None, 3, 0, None)]


def test_subtotals_tell_null_from_total(spark, rows):
    df = spark.createDataFrame([(None, "x", 1), ("a", "x", 2), ("a", None, 4)], "p string, q string, v int")
    measures = {"v": ("sum", F.col("v")), "n": ("count", F.lit(1)), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}
    cube = subtotals(df, cube_sets(["p", "q"]), measures)
    native = df.cube("p", "q").agg(
        F.grouping_id().cast("int").alias("level_id"), F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    assert rows(cube) == rows(native)
    assert rows(cube.where("p is null and q is null"), "level_id", "v") == [(1, 1), (2, 4), (3, 7)]
    rollup = subtotals(df, rollup_sets(["p", "q"]), measures)
    assert rows(rollup, "p", "q", "level_id", "v") == rows(
        df.rollup("p", "q").agg(F.grouping_id().cast("int").alias("level_id"), F.sum("v").alias("v")), "p", "q", "level_id", "v"
    )


def test_period_compare_skips_nothing(spark, rows):
    months = [(date(2023, 1, 1), 1), (date(2023, 12, 1), 2), (date(2024, 1, 1), 5), (date(2024, 3, 1), 9)]
    df = spark.createDataFrame([("k", m, v) for m, v in months], "k string, m date, v int")
    got = period_compare(df, "m", "k", "v")
    assert rows(got, F.col("m").cast("string"), "v", "prev_month", "last_year") == [
        ("2023-01-01", 1, None, None),
        ("2023-12-01", 2, None, None),
        ("2024-01-01", 5, 2, 1),
        ("2024-03-01", 9, None, None),
    ]


def test_top_k_ties(spark, rows):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate([9, 9, 8, 8, 7])], "g string, i int, v int")
    by_value, total = [F.col("v").desc()], [F.col("v").desc(), F.col("i")]
    assert rows(top_k(df, ["g"], total, 3), "i") == [(0,), (1,), (2,)]
    assert rows(top_k(df, ["g"], by_value, 3, "rank"), "i") == [(0,), (1,), (2,), (3,)]
    assert rows(top_k(df, ["g"], by_value, 3, "dense_rank"), "i") == [(0,), (1,), (2,), (3,), (4,)]


def test_pivot_and_back(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("b", "z", 9)], "k string, c string, v int")
    wide = pivot(df, ["k"], "c", ["x", "y"], F.sum("v"))
    assert rows(wide) == [("a", 1, 2), ("b", 3, None)]
    assert rows(unpivot(wide, ["k"], ["x", "y"], "c", "v").where("v is not null")) == [("a", "x", 1), ("a", "y", 2), ("b", "x", 3)]


@pytest.mark.parametrize("task_rows", [10, 10**6])
def test_percentiles_of_any_shape(spark, task_rows):
    draw = random.Random(3)
    groups = {
        "one": [4.0],
        "same": [2.5] * 40,
        "even": [float(i) for i in range(101)],
        # nearly everything in the first of any equal cells
        "tail": [draw.random() for _ in range(300)] + [1e12, -1e9],
        "hot": [1.0] * 200 + [draw.uniform(0, 2) for _ in range(100)],
    }
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values] + [("even", None)], "g string, v double")
    points = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = {(r["g"], r["p"]): r["value"] for r in percentiles(df, "g", "v", points, buckets=8, task_rows=task_rows).collect()}
    for g, values in groups.items():
        values = sorted(values)
        for p in points:
            spot = (len(values) - 1) * p
            low, high = values[int(spot)], values[min(int(spot) + 1, len(values) - 1)]
            assert got[g, p] == pytest.approx(low + (high - low) * (spot - int(spot)), rel=1e-12), (g, p)
    assert len(got) == len(groups) * len(points)
    assert got["even", 0.5] == statistics.median(groups["even"])


def test_approximate_percentiles(spark):
    df = spark.range(10001).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v"))
    got = {r["p"]: r["value"] for r in percentiles(df, "g", "v", [0.1, 0.9], exact=False).collect()}
    assert got[0.1] == pytest.approx(1000, abs=10) and got[0.9] == pytest.approx(9000, abs=10)


def test_sketches_and_bitmaps_merge(spark, rows):
    df = spark.range(60000).select((F.col("id") % 3).alias("part"), (F.col("id") % 40000).alias("x"))
    exact = merge_bitmaps(distinct_bitmap(df, ["part"], "x").withColumn("all", F.lit(1)), ["all"])
    assert rows(exact) == [(1, 40000)]
    close = merge_sketches(distinct_sketch(df, ["part"], "x").withColumn("all", F.lit(1)), ["all"])
    assert close.first()["n_distinct"] == pytest.approx(40000, rel=0.05)


@pytest.mark.parametrize("pieces", [None, 1, 7])
def test_rank_and_tiles(spark, pieces):
    draw = random.Random(5)
    values = [(i, Decimal(1) if draw.random() < 0.5 else Decimal(draw.randint(0, 50))) for i in range(157)]
    df = spark.createDataFrame(values, "k bigint, v decimal(10,2)").repartition(5)
    ranked = sorted_ranks(df, ["v", "k"], "rank", pieces)
    got = ranked.withColumn("tile", tile_of(F.col("rank"), F.lit(157), 5)).collect()
    wanted = sorted(values, key=lambda r: (r[1], r[0]))
    assert [(r["rank"], r["k"]) for r in sorted(got, key=lambda r: r["rank"])] == [(n, k) for n, (k, _) in enumerate(wanted, 1)]
    sizes = [sum(r["tile"] == t for r in got) for t in range(1, 6)]
    assert sizes == [32, 32, 31, 31, 31]


def test_ranks_of_texts_and_nulls(spark, rows):
    values = [("b", 1), (None, 2), ("a", 3), ("ä", 4), ("", 5), ("b", 0)]
    df = spark.createDataFrame(values, "t string, n int")
    assert rows(sorted_ranks(df, ["t", "n"], "rank", 4), "rank", "n") == [(1, 2), (2, 5), (3, 3), (4, 0), (5, 1), (6, 4)]
    assert sorted_ranks(df.limit(0), ["t"], "rank").count() == 0


@pytest.mark.parametrize("n", [1, 3, 5, 7, 11])
def test_tiles_are_ntile(spark, rows, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("r"), F.expr("ntile(5) over (order by id)").alias("t"))
    assert df.where(tile_of(F.col("r"), F.lit(n), 5) != F.col("t")).count() == 0


def test_fill_days(spark, rows):
    df = spark.createDataFrame([(date(2024, 2, 27), 1), (date(2024, 3, 1), 2)], "day date, n int")
    assert rows(fill_days(df), F.col("day").cast("string"), "n") == [
        ("2024-02-27", 1),
        ("2024-02-28", None),
        ("2024-02-29", None),
        ("2024-03-01", 2),
    ]
