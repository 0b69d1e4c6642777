"""A key with a third of all rows: chunked results equal plain ones, and no task gets it all."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kelda.functions.ordered import CHUNK, chunk_time, running_sum
from kelda.operators.behaviour import last_before, sessionize, transitions
from kelda.operators.dims import dim_as_of, scd2_build, scd2_merge
from kelda.operators.facts import allocate
from kelda.operators.metrics import running_share, top_k
from kelda.operators.skew import SALT, hot_keys, salted_join, with_salts

START = datetime(2024, 1, 1)
FEW, MANY = 20, 10**9  # busy limits: chunk the hot key, chunk nothing


@pytest.fixture(scope="module")
def events(spark):
    draw = random.Random(7)
    rows = []
    for i in range(900):
        user = 0 if draw.random() < 0.35 else draw.randint(1, 60)
        # Bursts, pauses and events at full hours, so that chunks border on one another.
        at = START + timedelta(minutes=draw.choice([draw.randint(0, 6000), 60 * draw.randint(0, 100)]))
        rows.append((i, user, at, draw.choice("ab"), draw.choice("xyz"), draw.randint(1, 9)))
    df = spark.createDataFrame(
        rows, "id bigint, user int, ts timestamp_ntz, type string, attr string, n int"
    )
    # One row per user and time: sessions and order must not depend on ties.
    return df.dropDuplicates(["user", "ts"]).orderBy("id").coalesce(1).cache()


def test_only_busy_keys_are_chunked(events):
    chunked = chunk_time(events, ["user"], "ts", "hour", FEW + 10)
    assert {r["user"] for r in chunked.where(f"{CHUNK} is not null").collect()} == {0}
    assert CHUNK not in chunk_time(events, ["user"], "ts", "hour", MANY).columns


@pytest.mark.parametrize("grain", ["hour", "day"])
@pytest.mark.parametrize("gap", ["20 minutes", "1 hour", "5 hours"])
def test_sessionize(events, rows, gap, grain):
    plain = sessionize(events, "user", "ts", gap, grain, MANY)
    chunked = sessionize(events, "user", "ts", gap, grain, FEW)
    assert rows(chunked, "id", "session_start") == rows(plain, "id", "session_start")


@pytest.fixture(scope="module")
def gappy(events):
    """Events of which some have no user, some no time."""
    user = F.when(F.col("id") % 5 != 1, F.col("user"))
    ts = F.when(F.col("id") % 17 != 2, F.col("ts"))
    return events.select("id", user.alias("user"), ts.alias("ts"), "type", "attr", "n").cache()


@pytest.mark.parametrize("busy", [1, 2])
def test_nulls_are_the_same_on_both_paths(gappy, rows, busy):
    a, b = gappy.where("type = 'a'"), gappy.where("type = 'b'")
    history = scd2_build(a, "user", ["attr"], "ts", "id")
    both = {
        "sessions": lambda n: sessionize(gappy, "user", "ts", "1 hour", "hour", n).select("id", "session_start"),
        "history": lambda n: scd2_build(gappy, "user", ["attr"], "ts", "id", "hour", n),
        "merge": lambda n: scd2_merge(history, a, b, "user", ["attr"], "ts", "id", "hour", n),
        "as of": lambda n: dim_as_of(b, history, "user", "ts", grain="hour", busy=n),
        "last before": lambda n: last_before(b, a, "user", "ts", ["id"], "id", "last_", "hour", n),
        "transitions": lambda n: transitions(gappy, "user", "ts", "attr", "id", "hour", n),
        "share": lambda n: running_share(gappy, "user", ["ts", "id"], "n", F.to_date("ts"), n),
    }
    for name, make in both.items():
        assert rows(make(busy)) == rows(make(MANY)), name


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_history(events, rows, grain):
    args = ("user", ["attr"], "ts", "id", grain)
    assert rows(scd2_build(events, *args, FEW)) == rows(scd2_build(events, *args, MANY))


def test_history_merge_equals_rebuild(events, rows):
    args = ("user", ["attr"], "ts", "id", "hour", FEW)
    early, late = events.where("n < 7"), events.where("n >= 7")
    merged = scd2_merge(scd2_build(early, *args), early, late, *args)
    assert rows(merged) == rows(scd2_build(events, *args))


def test_as_of(events, rows):
    history = scd2_build(events.where("type = 'a'"), "user", ["attr"], "ts", "id")
    facts = events.where("type = 'b'").select("id", "user", "ts")
    chunked = dim_as_of(facts, history, "user", "ts", grain="hour", busy=FEW)
    versions = history.withColumnRenamed("user", "u")
    joined = facts.join(
        versions, F.expr("user = u and ts >= valid_from and ts < valid_to"), "left"
    ).drop("u")
    assert rows(chunked, *joined.columns) == rows(joined)


def test_last_before(events, rows):
    target, source = events.where("type = 'b'"), events.where("type = 'a'")
    args = (target, source, "user", "ts", ["id", "attr"], "id", "last_", "hour")
    assert rows(last_before(*args, FEW)) == rows(last_before(*args, MANY))


def test_transitions(events, rows):
    args = (events, "user", "ts", "attr", "id", "hour")
    assert rows(transitions(*args, FEW)) == rows(transitions(*args, MANY))


def test_running_share(events, rows):
    columns = ["id", "running_total", "group_total", "share", "running_share"]
    for chunk in (F.to_date("ts"), F.struct("ts", F.floor(F.col("id") / 100))):
        args = (events, "user", ["ts", "id"], "n", chunk)
        few, many = (running_share(*args, busy).select(columns) for busy in (FEW, MANY))
        assert rows(few) == rows(many)


def test_running_sum_with_nulls(spark, rows):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 1, null), (1, 2, 5), (2, 3, null), (2, 4, 2), (3, 5, null) AS t(c, o, v)"
    )
    plain = running_sum(df, [], ["o"], "v", "s", "t")
    chunked = running_sum(df.withColumnRenamed("c", CHUNK), [], ["o"], "v", "s", "t")
    expected = [(1, None, 7), (2, 5, 7), (3, 5, 7), (4, 7, 7), (5, 7, 7)]
    assert rows(plain, "o", "s", "t") == rows(chunked, "o", "s", "t") == expected


def test_salted_join(events, spark, rows):
    users = spark.range(50).select(F.col("id").cast("int").alias("user"), F.col("id").alias("x"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        salted = salted_join(events, users, ["user"], 5, how)
        assert rows(salted) == rows(events.join(users, ["user"], how))
        by_id = salted_join(events, users, ["user"], 5, how, ["id"])
        assert rows(by_id) == rows(events.join(users, ["user"], how))
    # One user is hot: its member is there under all salts, others once.
    hot = hot_keys(events, ["user"], 0.2)
    assert hot == [users.where("user = 0").select(F.xxhash64("user")).first()[0]]
    repeated = with_salts(users, ["user"], hot, 5)
    assert repeated.count() == 50 + 4 and repeated.where("user = 0").select(SALT).distinct().count() == 5
    # Without hot keys it is the plain join.
    even = spark.range(5000).select(F.col("id").cast("int").alias("user"))
    assert hot_keys(even, ["user"], 0.01) == []
    assert "Generate" not in salted_join(even, users, ["user"], 5)._jdf.queryExecution().toString()
    # Rows that are all alike are joined once, whatever their number.
    alike = spark.range(10_000).select(F.lit(0).alias("user"))
    joined = salted_join(alike, users, ["user"], 8)
    assert joined.count() == 10_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Join")[1]


def test_hot_keys_of_many(spark, rows):
    """Frequent keys are found among many rare ones, nulls and several columns too."""
    rare = spark.range(60_000).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    some = spark.range(3000).select((F.col("id") % 3).alias("a"), F.lit("y").alias("b"))
    none = spark.range(2000).select(F.lit(None).cast("bigint").alias("a"), F.lit("z").alias("b"))
    df = rare.unionByName(some).unionByName(none).repartition(7)
    wanted = df.groupBy("a", "b").count().where("count >= 900").select(F.xxhash64("a", "b"))
    assert [(h,) for h in hot_keys(df, ["a", "b"], 0.013)] == sorted(map(tuple, wanted.collect()))
    with pytest.raises(ValueError):
        hot_keys(df, ["a"], 0.001)
    assert hot_keys(df.limit(0), ["a"], 0.1) == []
    small = spark.createDataFrame([(0, "y", 1), (1, "y", 2), (5, "x", 3), (None, "z", 4)], "a bigint, b string, c int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(salted_join(df, small, ["a", "b"], 3, how).groupBy("a").count().where("count > 1")) == rows(
            df.join(small, ["a", "b"], how).groupBy("a").count().where("count > 1")
        )


def test_allocation_adds_up(spark, rows):
    # One order has most lines; one weighs nothing; amounts do not divide evenly.
    lines = spark.range(400).select(
        F.when(F.col("id") < 300, 1).when(F.col("id") < 310, 2).otherwise(F.col("id")).alias("l_orderkey"),
        F.col("id").alias("line"),
        F.when(F.col("id").between(300, 309), 0).otherwise(F.col("id") % 7 + 1).cast("decimal(18,2)").alias("w"),
        F.lit("100.01").cast("decimal(18,2)").alias("amount"),
    )
    split = allocate(lines, "amount", "w", ["line"])
    amounts = lines.select("l_orderkey", "amount").distinct()
    apart = allocate(lines.drop("amount"), "amount", "w", ["line"], amounts=amounts)
    assert rows(apart, "line", "allocated") == rows(split, "line", "allocated")
    # Orders with more lines than one task should take are joined instead.
    assert rows(allocate(lines, "amount", "w", ["line"], busy=50), "line", "allocated") == rows(split, "line", "allocated")
    orphans = allocate(lines.drop("amount"), "amount", "w", ["line"], amounts=amounts.where("l_orderkey <> 1"))
    assert orphans.count() == 400 and orphans.where("allocated is null").count() == 300
    totals = split.groupBy("l_orderkey").agg(F.sum("allocated").alias("s"), F.min("allocated").alias("lo"))
    assert totals.where("s <> 100.01 or lo < 0").count() == 0
    assert split.count() == 400
    assert rows(split.where("l_orderkey = 2 and allocated > 0"), "line") == [(309,)]


def test_top_k_limits_before_the_shuffle(spark):
    rows = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 2).alias("g"))
    best = top_k(rows, ["g"], [F.col("id").desc()], 3)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
