import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kelda.operators.behaviour import (
    active_users,
    bounce_rate,
    funnel,
    funnel_counts,
    lifecycle,
    peak_concurrency,
    repeat_rate,
    retention,
    rfm,
    sessions,
    streaks,
)
from kelda.operators.quality import (
    check_fk,
    check_rules,
    check_unique,
    check_volume,
    daily_volume,
    reconcile,
)

START = datetime(2024, 1, 1)
EVENT = "k int, ts timestamp_ntz, type string"


def at(**kw):
    return START + timedelta(**kw)


def days(spark, active):
    return spark.createDataFrame([(k, at(days=d), "e") for k, ds in active.items() for d in ds], EVENT)


def test_session_gap_is_exclusive(spark, rows):
    ts = [at(), at(hours=1), at(hours=2, microseconds=1)]
    got = sessions(spark.createDataFrame([(1, t, "e") for t in ts], EVENT), "k", "ts", "1 hour")
    assert rows(got, "session_start", "session_end", "n_events") == [(ts[0], ts[1], 2), (ts[2], ts[2], 1)]
    assert rows(bounce_rate(got)) == [(2, 1, 0.5)]
    native = spark.createDataFrame([(1, t, "e") for t in ts], EVENT).groupBy("k", F.session_window("ts", "1 hour")).count()
    assert rows(native, "count") == [(1,), (2,)]


def test_active_users(spark, rows):
    ev = days(spark, {1: [0, 0, 3], 2: [1], 3: [9]})
    got = active_users(ev, "k", "ts", [1, 3])
    expected = [(1, 1), (1, 2), (0, 2), (1, 2), (0, 1), (0, 1), (0, 0), (0, 0), (0, 0), (1, 1)]
    assert [(r["active_1d"], r["active_3d"]) for r in got.orderBy("day").collect()] == expected


def test_lifecycle(spark, rows):
    got = lifecycle(days(spark, {1: [0, 2, 6], 2: [7]}), "k", "ts", 3)
    assert rows(got, "k", F.dayofmonth("day"), "state") == [
        (1, 1, "new"),
        (1, 3, "continuing"),
        (1, 6, "lapsed"),
        (1, 7, "returned"),
        (2, 8, "new"),
    ]


def test_retention(spark, rows):
    got = retention(days(spark, {1: [0, 1], 2: [0, 2, 2], 3: [1]}), "k", "ts")
    assert rows(got, F.dayofmonth("cohort"), "day_offset", "active", "cohort_size") == [
        (1, 0, 2, 2),
        (1, 1, 1, 2),
        (1, 2, 1, 2),
        (2, 0, 1, 1),
    ]


def test_streaks(spark, rows):
    got = streaks(days(spark, {1: [0, 1, 3], 2: [5]}), "k", "ts")
    assert rows(got, "k", F.dayofmonth("first_day"), "days") == [(1, 1, 2), (1, 4, 1), (2, 6, 1)]


STEPS = ["a", "b", "c"]


def slow_funnel(events, limit):
    furthest = {}
    for key in {k for k, _, _ in events}:
        own = sorted((t, y) for k, t, y in events if k == key)
        for start, kind in own:
            if kind != STEPS[0]:
                continue
            step, now = 1, start
            while step < len(STEPS):
                later = [t for t, y in own if y == STEPS[step] and now < t <= start + limit]
                if not later:
                    break
                step, now = step + 1, min(later)
            furthest[key] = max(furthest.get(key, 0), step)
    return sorted(furthest.items())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hours", [1, 5, 30])
def test_funnel_against_brute_force(spark, rows, seed, hours):
    draw = random.Random(seed)
    events = [(draw.randint(0, 5) if draw.random() < 0.6 else 0, at(minutes=30 * draw.randint(0, 150)), draw.choice("aabcd")) for _ in range(120)]
    got = funnel(spark.createDataFrame(events, EVENT), "k", "ts", "type", STEPS, f"{hours} hours", "3 hours")
    assert rows(got) == slow_funnel(events, timedelta(hours=hours))


def test_funnel_borders(spark, rows):
    within = [(1, at(hours=23), "a"), (1, at(hours=24), "b"), (1, at(hours=25), "c")]
    too_late = [(2, at(hours=23), "a"), (2, at(hours=24), "b"), (2, at(hours=25, microseconds=1), "c")]
    same_time = [(3, at(), "a"), (3, at(), "b")]
    got = funnel(spark.createDataFrame(within + too_late + same_time, EVENT), "k", "ts", "type", STEPS, "2 hours")
    assert rows(got) == [(1, 3), (2, 2), (3, 1)]
    assert rows(funnel_counts(got, STEPS)) == [(1, "a", 3), (2, "b", 2), (3, "c", 1)]


def test_rfm_has_equal_groups(spark):
    orders = spark.range(230).select(
        (F.col("id") % 23).alias("o_custkey"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,cast(id as int))").alias("o_orderdate"),
        F.lit(1.0).alias("o_totalprice"),
    )
    got = rfm(orders, F.lit(date(2025, 1, 1))).collect()
    assert len(got) == 23
    # Equal frequency and value: quintiles follow the key alone.
    by_key = sorted(got, key=lambda r: r["o_custkey"])
    assert [r["f_score"] for r in by_key] == [r["m_score"] for r in by_key] == sorted([1, 2, 3] * 5 + [4, 5] * 4)
    assert [r["r_score"] for r in by_key] == sorted([1, 2, 3] * 5 + [4, 5] * 4)


def test_rfm_with_one_customer_far_ahead(spark):
    # Equal-width pieces would put all others into one.
    orders = spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 211).alias("o_custkey"),
        F.expr("timestamp_ntz'2024-01-01'").alias("o_orderdate"),
        F.when(F.col("id") < 1000, 1e6).otherwise(F.col("id") % 17).alias("o_totalprice"),
    )
    got = rfm(orders, F.lit(date(2025, 1, 1)), pieces=16)
    per_key = orders.groupBy("o_custkey").agg(
        F.count("*").alias("f"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("m")
    )
    wanted = per_key.select(
        "o_custkey",
        F.expr("ntile(5) over (order by f, o_custkey)").alias("f_score"),
        F.expr("ntile(5) over (order by m, o_custkey)").alias("m_score"),
    )
    assert got.select(*wanted.columns).exceptAll(wanted).isEmpty()


def test_repeat_rate(spark, rows):
    orders = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", 1)], "g string, o_custkey int")
    assert rows(repeat_rate(orders, "g")) == [("x", 2, 1, 0.5), ("y", 1, 0, 0.0)]


def test_peak_concurrency(spark, rows):
    spans = [(at(hours=1), at(hours=3)), (at(hours=2), at(hours=50)), (at(hours=3), at(hours=4)), (at(hours=5), at(hours=5)), (at(hours=40), at(hours=48)), (at(hours=48), at(hours=49))]
    iv = spark.createDataFrame(spans, "s timestamp_ntz, e timestamp_ntz")
    # Touching intervals do not overlap; day 2 is entered with one interval open.
    assert rows(peak_concurrency(iv, "s", "e"), F.dayofmonth("day"), "peak") == [(1, 2), (2, 2), (3, 2)]
    quiet = spark.createDataFrame([(at(hours=1), at(hours=60))], "s timestamp_ntz, e timestamp_ntz")
    assert rows(peak_concurrency(quiet, "s", "e"), F.dayofmonth("day"), "peak") == [(1, 1), (2, 1), (3, 1)]


def test_unique_and_rules(spark, rows):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 50), (None, 7)], "k int, v int")
    assert rows(check_unique(df, ["k"], "t")) == [("t", "unique(k)", 2, 4)]
    rules = {"set": F.col("v").isNotNull(), "small": F.col("v") < 10}
    assert rows(check_rules(df, rules, "t")) == [("t", "set", 1, 4), ("t", "small", 2, 4)]
    assert rows(check_unique(df.limit(0), ["k"], "t")) == [("t", "unique(k)", 0, 0)]


def test_foreign_key_ignores_null(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "c int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "p int")
    assert rows(check_fk(child, parent, ("c", "p"), "t")) == [("t", "fk(c->p)", 2, 5)]


def test_reconcile(spark, rows):
    a = spark.createDataFrame([(1,), (2,)], "v int")
    b = spark.createDataFrame([(3,), (0,)], "v int")
    measures = {"v": (F.col("v"), F.col("v")), "twice": (F.col("v") * 2, F.col("v"))}
    assert rows(reconcile(a, b, measures, "t")) == [("t", "row count", 0, 2), ("t", "sum(twice)", 1, 2), ("t", "sum(v)", 0, 2)]


def test_volume(spark, rows):
    counts = [10, 12, 11, 9, 0, 100]
    ts = [(at(days=d, minutes=i),) for d, n in enumerate(counts) for i in range(n)]
    df = spark.createDataFrame(ts, "ts timestamp_ntz")
    assert rows(daily_volume(df, "ts", 3), "n", "days_before")[0] == (0, 3)
    assert rows(check_volume(df, "ts", 3, 3.0, "t")) == [("t", "has ts", 0, 142), ("t", "volume(3d)", 100, 142)]
    untimed = df.unionByName(df.limit(2).withColumn("ts", F.lit(None).cast(df.schema["ts"].dataType)))
    assert rows(check_volume(untimed, "ts", 3, 3.0, "t")) == [("t", "has ts", 2, 144), ("t", "volume(3d)", 100, 144)]


def test_rfm_with_keys_of_any_type(spark):
    orders = spark.range(2000).select(
        F.concat(F.lit("k"), (F.col("id") * 7 % 173).cast("string")).alias("name"),
        (F.col("id") * 7 % 173).cast("decimal(20,3)").alias("number"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,cast(id % 40 as int))").alias("o_orderdate"),
        (F.col("id") % 5).cast("double").alias("o_totalprice"),
    )
    orders = orders.withColumn("both", F.struct("number", "name")).withColumn("name", F.when(F.col("name") != "k5", F.col("name")))
    day = F.lit(date(2025, 1, 1))
    for key in ("name", "number", "both"):
        got = rfm(orders, day, key=key, pieces=9)
        per_key = orders.groupBy(key).agg(
            F.datediff(day, F.max("o_orderdate")).alias("r"), F.count("*").alias("f"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("m"),
        )
        wanted = per_key.select(
            key,
            F.expr(f"ntile(5) over (order by r desc, {key})").alias("r_score"),
            F.expr(f"ntile(5) over (order by f, {key})").alias("f_score"),
            F.expr(f"ntile(5) over (order by m, {key})").alias("m_score"),
        )
        assert got.select(*wanted.columns).exceptAll(wanted).isEmpty() and got.count() == 173
    assert rfm(orders.limit(0), day, key="name").count() == 0
