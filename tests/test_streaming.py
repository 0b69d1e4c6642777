"""Streams over several files: equal to batch on what is closed, late rows, replays."""

import os
import random
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelda.operators.dims import dim_as_of, scd2_build
from kelda.operators.maintenance import apply_cdc
from kelda.operators.skew import hot_keys
from kelda.streaming import joins, sinks, state, windows
from kelda.streaming.source import event_stream

START = datetime(2024, 1, 1)
LIMIT = 120


def at(**kw):
    return START + timedelta(**kw)


def schema():
    return T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("user", T.StringType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("type", T.StringType()),
        ]
    )


ARROW = pa.schema([("id", pa.int64()), ("user", pa.string()), ("ts", pa.timestamp("us")), ("type", pa.string())])


@pytest.fixture
def feed(spark, tmp_path):
    """A stream that delivers the given lists of rows one file at a time, in that order."""

    def build(*files, max_files=1):
        folder = tmp_path / f"in-{uuid.uuid4().hex}"
        folder.mkdir()
        for i, rows in enumerate(files):
            path = folder / f"{i}.parquet"
            pq.write_table(pa.Table.from_pylist([dict(zip(ARROW.names, r)) for r in rows], ARROW), path)
            os.utime(path, (1_700_000_000 + 60 * i,) * 2)
        return event_stream(spark, str(folder), schema(), max_files=max_files)

    return build


@pytest.fixture
def finish(spark, tmp_path):
    """Run a stream (or a ready writer) to its end; the sink's table and its checkpoint."""

    def go(df, mode="append", path=None):
        path = path or str(tmp_path / f"out-{uuid.uuid4().hex}")
        sinks.run(sinks.idempotent_sink(df, path, mode), f"{path}-cp", LIMIT)
        return sinks.read_sink(spark, path, df.schema)

    return go


def events(n=240, seed=1, users=6, hours=40):
    draw = random.Random(seed)
    return [
        (i, str(draw.choice([0, 0, 0, *range(users)])), at(minutes=i * hours * 60 / n, microseconds=draw.randint(0, 999_999)), draw.choice("abc"))
        for i in range(n)
    ]


def quarters(rows):
    size = len(rows) // 4
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def closed(rows, delay):
    return max(r[2] for r in rows) - delay


def test_tumbling_sliding_and_days(spark, feed, finish, rows):
    data = events()
    end = closed(data, timedelta(hours=2))
    batch = spark.createDataFrame(data, schema()).withColumn("ts", F.col("ts").cast("timestamp"))
    before = F.col("window_end") <= F.lit(end).cast("timestamp_ntz").cast("timestamp")

    def same(make, flat=windows.flat):
        wanted = flat(make(batch)).where(before)
        got = finish(flat(make(feed(*quarters(data)))))
        assert rows(got) == rows(wanted) != []

    same(lambda df: windows.tumbling(df, "ts", "1 hour", "2 hours", ["type"]))
    same(lambda df: windows.sliding(df, "ts", "3 hours", "1 hour", "2 hours"))
    same(lambda df: windows.rewindow(windows.tumbling(df, "ts", "1 hour", "2 hours", ["type"]), "4 hours", ["type"]))
    same(lambda df: windows.sessions(df, "user", "ts", "20 minutes", "2 hours"), lambda df: df)


def test_sliding_windows_are_made_of_panes(spark, feed, finish, rows):
    data = events(200, hours=30)
    end = closed(data, timedelta(hours=2))
    measures = {"n": F.count("*"), "last": F.max("id"), "ids": F.sum("id")}
    merge = {"n": F.sum("n"), "last": F.max("last"), "ids": F.sum("ids")}
    make = lambda df: windows.sliding(df, "ts", "90 minutes", "1 hour", "2 hours", ["type"], measures, merge)
    wanted = {}
    for i, _, t, kind in data:
        first = START + timedelta(hours=(t - START - timedelta(minutes=90)) // timedelta(hours=1))
        for k in range(3):
            start = first + timedelta(hours=k)
            if start <= t < start + timedelta(minutes=90) <= end:
                wanted.setdefault((start, kind), []).append(i)
    wanted = [(s, y, len(ids), max(ids), sum(ids)) for (s, y), ids in wanted.items()]
    stream = windows.flat(make(feed(*quarters(data))))
    got = finish(stream).withColumn("s", F.col("window_start").cast("timestamp_ntz"))
    assert rows(got, "s", "type", "n", "last", "ids") == sorted(wanted, key=repr) != []
    # Rows are not copied: what is copied comes out of the first aggregate.
    batch = spark.createDataFrame(data, schema()).withColumn("ts", F.col("ts").cast("timestamp"))
    plan = make(batch)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan.split("partial_count")[1]
    with pytest.raises(ValueError):
        windows.sliding(batch, "ts", "2 hours", "1 hour", "1 hour", (), measures)


def test_session_border(feed, finish, rows):
    ts = [at(), at(minutes=20), at(minutes=40, microseconds=1), at(days=1)]
    stream = feed([(i, "u", t, "a") for i, t in enumerate(ts)])
    got = finish(windows.sessions(stream, "user", "ts", "20 minutes", "1 hour"))
    assert rows(got, "n") == [(1,), (2,)]


def forget_last_commit(checkpoint):
    """As after a crash between writing the last batch and noting that it is done."""
    for name in ("3", ".3.crc"):
        (Path(checkpoint) / "commits" / name).unlink()


def late_order(order):
    data = events(400, hours=100)
    parts = quarters(data)
    return [parts[i - 1] for i in order]


@pytest.mark.parametrize("order, late", [((1, 2, 3, 4), 0), ((1, 3, 2, 4), 1), ((1, 3, 4, 2), 1)])
def test_split_late(spark, feed, tmp_path, rows, order, late):
    files = late_order(order)
    path = str(tmp_path / "split")
    checkpoint = f"{path}-cp"
    stream = feed(*files)
    run = lambda: sinks.run(sinks.split_late(stream, "ts", "5 hours", path), checkpoint, LIMIT)
    run()
    seen, expected = None, set()
    for rows_in in files:
        if seen:
            expected |= {r[0] for r in rows_in if r[2] < seen - timedelta(hours=5)}
        seen = max([*([seen] if seen else []), *(r[2] for r in rows_in)])
    assert bool(expected) == bool(late)
    result = lambda: spark.read.parquet(f"{path}/rows")
    assert {r["id"] for r in result().where("late = 'true'").collect()} == expected
    assert rows(result(), "id") == sorted(((r[0],) for f in files for r in f), key=repr)
    forget_last_commit(checkpoint)
    before = rows(result(), "id", "late")
    run()
    assert rows(result(), "id", "late") == before


def test_late_rows_are_not_in_windows(feed, finish, rows):
    count = lambda files: sum(
        n for (n,) in rows(finish(windows.tumbling(feed(*files), "ts", "1 hour", "1 hour")), "n")
    )
    in_order = count(late_order((1, 2, 3, 4)))
    assert count(late_order((1, 3, 4, 2))) < in_order


def test_sink_replays_are_harmless_and_appending_is_not(spark, feed, tmp_path):
    data = events(80)
    stream = feed(*quarters(data))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")

    def append(batch, batch_id):
        batch.write.mode("append").parquet(bad)

    writers = {
        good: lambda: sinks.idempotent_sink(stream, good),
        bad: lambda: stream.writeStream.foreachBatch(append),
    }
    for path, writer in writers.items():
        sinks.run(writer(), f"{path}-cp", LIMIT)
        assert spark.read.parquet(path).count() == 80
        forget_last_commit(f"{path}-cp")
        sinks.run(writer(), f"{path}-cp", LIMIT)
    assert spark.read.parquet(good).count() == 80
    assert spark.read.parquet(bad).count() == 100


def test_dedupe(feed, finish, rows):
    data = events(80)
    again = [(i, u, t + timedelta(minutes=1), y) for i, u, t, y in data if i % 7 == 0]
    files = quarters(sorted(data + again, key=lambda r: r[2]))
    got = finish(joins.dedupe(feed(*files), "id", "ts", "1 hour"))
    assert rows(got, "id") == sorted(((r[0],) for r in data), key=repr)


def test_enrich(spark, feed, finish, rows):
    dim = spark.createDataFrame([("0", "zero"), ("1", "one")], "u string, name string")
    data = events(40)
    got = finish(joins.enrich(feed(*quarters(data)), dim, ("user", "u")).select("id", "name"))
    names = {"0": "zero", "1": "one"}
    assert rows(got) == sorted(((r[0], names.get(r[1])) for r in data), key=repr)


def test_enrich_spreads_hot_keys(spark, feed, finish, rows):
    dim = spark.createDataFrame([("0", "zero"), ("1", "one")], "u string, name string")
    data = events(120)
    known = spark.createDataFrame(data[:60], schema())
    hot = hot_keys(known, ["user"], 0.3)
    assert len(hot) == 1
    stream = joins.enrich(feed(*quarters(data)), dim, ("user", "u"), hot, salts=4)
    assert stream.columns == ["id", "user", "ts", "type", "u", "name"]
    names = {"0": "zero", "1": "one"}
    assert rows(finish(stream.select("id", "name"))) == sorted(((r[0], names.get(r[1])) for r in data), key=repr)


def test_enrich_as_of(spark, feed, tmp_path, rows):
    data = events(120)
    changes = spark.createDataFrame(
        [(str(u), at(hours=7 * i + u).replace(microsecond=0), "xy"[(i + u) % 2], i) for u in range(4) for i in range(5)],
        "user string, at timestamp, attr string, tie int",
    )
    dim = scd2_build(changes, "user", ["attr"], "at", "tie").cache()
    path = str(tmp_path / "as-of")
    stream = feed(*quarters(data))
    sinks.run(sinks.enrich_as_of(stream, dim, "user", "ts", path), f"{path}-cp", LIMIT)
    batch = spark.createDataFrame(data, schema()).withColumn("ts", F.col("ts").cast("timestamp"))
    wanted = dim_as_of(batch, dim, "user", "ts")
    got = spark.read.parquet(path)
    assert rows(got, "id", "attr", "valid_from") == rows(wanted, "id", "attr", "valid_from")


@pytest.mark.parametrize("lo, hi", [("0 hours", "3 hours"), ("-2 hours", "1 hour")])
def test_interval_join(feed, finish, rows, lo, hi):
    data = events(200)
    files = quarters(data)
    low, high = (timedelta(hours=int(x.split()[0])) for x in (lo, hi))

    def side(kind, name):
        stream = feed(*files).where(F.col("type") == kind)
        return stream.select(F.col("id").alias(name), F.col("user").alias(f"{name}_user"), F.col("ts").alias(f"{name}_ts"))

    def join(how):
        return joins.interval_join(side("a", "x"), side("b", "y"), ("x_user", "y_user"), ("x_ts", "y_ts"), lo, hi, "1 hour", how)

    a, b = ([r for r in data if r[3] == kind] for kind in "ab")
    pairs = [(x[0], y[0]) for x in a for y in b if x[1] == y[1] and low <= y[2] - x[2] <= high]
    assert rows(finish(join("inner")), "x", "y") == sorted(pairs, key=repr) != []
    outer = rows(finish(join("left_outer")), "x", "y")
    assert [p for p in outer if p[1] is not None] == sorted(pairs, key=repr)
    alone = {x[0] for x in a} - {x for x, _ in pairs}
    got = {x for x, y in outer if y is None}
    # Only rows of the open interval at the end may be missing, and none is out twice.
    assert got <= alone and len(outer) == len(set(outer))
    open_from = closed(data, timedelta(hours=5))
    assert {x[0] for x in a if x[0] in alone and x[2] < open_from} <= got


def test_route_keeps_everything(spark, feed, tmp_path, rows):
    data = [*events(40), (99, "u", at(), None)]
    path = str(tmp_path / "routed")
    stream = feed(data[:20], data[20:])
    run = lambda: sinks.run(sinks.route(stream, "type", ("a", "b"), path, "rest"), f"{path}-cp", LIMIT)
    run()
    table = lambda k: sinks.read_route(spark, path, stream.schema, k)
    assert {r["type"] for r in table("a").collect()} == {"a"}
    assert {r["type"] for r in table("rest").collect()} == {"c", None}
    union = lambda: table("a").union(table("b")).union(table("rest"))
    assert rows(union(), "id") == sorted(((r[0],) for r in data), key=repr)
    for name in ("1", ".1.crc"):
        (Path(f"{path}-cp") / "commits" / name).unlink()
    run()
    assert rows(union(), "id") == sorted(((r[0],) for r in data), key=repr)
    with pytest.raises(ValueError):
        sinks.route(stream, "type", ("a", "rest"), path, "rest")


def test_cdc_in_any_order(spark, feed, tmp_path, rows):
    data = [*events(120), (500, None, at(), "a"), (501, "odd", at(), None)]
    shuffled = random.Random(2).sample(data, len(data))

    def changes(df):
        # A change without an operation is an update.
        op = F.when(F.col("type") == "c", "D").when(F.col("type").isNotNull(), "U")
        return df.select("user", "type", op.alias("op"), F.col("id").alias("seq"))

    stream, path = changes(feed(*quarters(shuffled))), str(tmp_path / "cdc")
    run = lambda: sinks.run(state.cdc_stream(stream, ["user"], "op", "seq", path), f"{path}-cp", LIMIT)
    run()
    batch = changes(spark.createDataFrame(data, schema()))
    wanted = rows(apply_cdc(batch.select("user", "type").limit(0), batch, ["user"], "op", "seq"))
    current = lambda: state.current_rows(spark, path, stream.schema, ["user"], "op", "seq")
    assert rows(current()) == wanted
    assert {(None, "a"), ("odd", None)} <= set(wanted)
    forget_last_commit(f"{path}-cp")
    run()
    assert rows(current()) == wanted


def first_days(data, keep):
    """First event of each user's day and whether the user is new, from all rows at once."""
    found, last = {}, {}
    for i, user, t, _ in data:
        day = t.date()
        if (user, day) not in found:
            away = user not in last or (keep and day - last[user] - timedelta(days=1) > keep)
            found[user, day] = (i, bool(away))
        last[user] = day
    return sorted(found.values(), key=repr)


@pytest.mark.parametrize("keep", [None, 2])
def test_first_seen(spark, feed, tmp_path, rows, keep):
    data = [r for r in events(300, hours=400) if (r[2].day + int(r[1])) % 5 < 2 or r[1] == "0"]
    data = [(i, None if u == "5" else u, t, y) for i, u, t, y in data]
    path = str(tmp_path / "first")
    stream = feed(*quarters(data))
    writer = lambda: state.first_seen(stream, "user", "ts", "id", path, f"{keep} days" if keep else None)
    sinks.run(writer(), f"{path}-cp", LIMIT)
    wanted = first_days(data, timedelta(days=keep) if keep else None)
    got = lambda: rows(spark.read.parquet(path), "first_id", "is_first_ever")
    assert got() == wanted != []
    news = sum(new for _, new in wanted)
    assert news > 6 if keep else news == 6
    forget_last_commit(f"{path}-cp")
    sinks.run(writer(), f"{path}-cp", LIMIT)
    assert got() == wanted


def test_window_top_k(spark, feed, tmp_path, rows):
    data = events(200)
    counted = windows.flat(windows.tumbling(feed(*quarters(data)), "ts", "6 hours", "1 hour", ["user"]))
    path = str(tmp_path / "top")
    order = [F.col("n").desc(), F.col("user")]
    sinks.run(sinks.window_top_k(counted, order, 2, path), f"{path}-cp", LIMIT)
    per_window = {}
    for _, user, t, _ in data:
        start = at(hours=int((t - START).total_seconds() // 3600 // 6 * 6))
        per_window.setdefault(start, {}).setdefault(user, []).append(1)
    wanted = []
    for start, users in per_window.items():
        if start + timedelta(hours=6) <= closed(data, timedelta(hours=1)):
            best = sorted(users, key=lambda u: (-len(users[u]), u))[:2]
            wanted += [(start, u, len(users[u]), i + 1) for i, u in enumerate(best)]
    got = spark.read.parquet(path).withColumn("s", F.col("window_start").cast("timestamp_ntz"))
    assert rows(got, "s", "user", "n", "place") == sorted(wanted, key=repr)


@pytest.mark.parametrize("b", ["b", "a"])
@pytest.mark.parametrize("hours", [3, 5])
def test_followed_by(feed, finish, rows, b, hours):
    data = [*events(200), (900, None, at(), "a"), (901, None, at(minutes=1), b)]
    data.sort(key=lambda r: r[2])
    args = ("user", "ts", "id", "type", "a", b, f"{hours} hours", "1 hour")
    within = timedelta(hours=hours)
    wanted = {}
    for i, user, t, kind in data:
        if kind == "a" and user is not None:
            after = [u for _, v, u, y in data if v == user and y == b and t < u <= t + within]
            wanted[i] = (t, min(after) if after else None)
    hit = state.first_answers(finish(state.followed_by(feed(*quarters(data)), *args)), "user")
    miss = finish(state.not_followed_by(feed(*quarters(data)), *args))
    answered = sorted(((i, u) for i, (_, u) in wanted.items() if u), key=repr)
    assert rows(hit, "a_id", F.col("b_ts").cast("timestamp_ntz")) == answered != []
    # Starts are settled at their own expiry: the watermark is the lower one of both sides.
    last = [max(r[2] for r in data if r[3] == kind and r[1] is not None) for kind in ("a", b)]
    end = min(last) - timedelta(hours=1)
    got = {i for (i,) in rows(miss, "a_id")}
    assert got == {i for i, (t, u) in wanted.items() if not u and t + within <= end} != set()
