"""Keyed state: busy keys, late rows, replays, expiry."""

import os
import time
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kelda.operators.dims import dim_as_of, scd2_build
from kelda.streaming import sinks, state
from kelda.streaming.source import event_stream
from tests.test_streaming import LIMIT, at, feed, forget_last_commit  # noqa: F401

ARGS = ("user", "ts", "id", "type", "a", "b", "1 hour", "1 hour")
HOUR = timedelta(hours=1)


def busy():
    """1,000 starts and 1,000 answers of one user side by side, then a row that closes them."""
    rows = []
    for k in range(1000):
        rows.append((2 * k, "hot", at(seconds=4 * k), "a"))
        rows.append((2 * k + 1, "hot", at(seconds=4 * k + 1 + (k % 3)), "b"))
    lonely = [(5000 + k, "hot", at(hours=3, seconds=k), "a") for k in range(10)]
    return [rows[:700], rows[700:], lonely, [(9000, "x", at(days=9), "a"), (9001, "x", at(days=9), "b")]]


def answers(files):
    events = [r for rows in files for r in rows]
    found = {}
    for i, user, t, kind in events:
        if kind == "a":
            after = [u for _, v, u, y in events if v == user and y == "b" and t < u <= t + HOUR]
            found[i] = min(after, default=None)
    return found


def go(df, path):
    return sinks.run(sinks.idempotent_sink(df, path), f"{path}-cp", LIMIT)


def state_rows(query):
    return query.lastProgress.stateOperators[0].numRowsTotal


@pytest.mark.parametrize("salts, stretch", [(1, 64), (3, 1)])
def test_busy_key(spark, feed, tmp_path, rows, salts, stretch):  # noqa: F811
    files = busy()
    wanted = answers(files)
    path = str(tmp_path / "hit")
    df = state.followed_by(feed(*files), *ARGS, salts=salts, stretch=stretch)
    query = go(df, path)
    written = spark.read.parquet(path)
    hits = rows(written, "a_id", F.col("b_ts").cast("timestamp_ntz"))
    # One row for each answered start, not one for each pair.
    assert hits == sorted(((i, t) for i, t in wanted.items() if t), key=repr) and len(hits) == 1000
    assert state_rows(query) <= 4 * salts  # the last key only
    forget_last_commit(f"{path}-cp")
    go(df, path)
    assert rows(spark.read.parquet(path), "a_id", F.col("b_ts").cast("timestamp_ntz")) == hits

    path = str(tmp_path / "miss")
    query = go(state.not_followed_by(feed(*files), *ARGS, salts=salts, stretch=stretch), path)
    assert rows(spark.read.parquet(path), "a_id") == sorted(((i,) for i, t in wanted.items() if not t and i < 9000), key=repr)
    assert state_rows(query) <= 4 * salts  # the last key only


def test_late_answers_and_starts(spark, feed, tmp_path, rows):  # noqa: F811
    files = [
        [(1, "u", at(minutes=0), "a"), (2, "u", at(minutes=30), "b"), (3, "v", at(minutes=30), "b")],
        # An earlier answer than the one that is out, and a start before an answer that is there.
        [(4, "u", at(minutes=10), "b"), (5, "v", at(minutes=20), "a"), (6, "v", at(minutes=30), "a")],
        [(7, "w", at(days=1), "a"), (8, "w", at(days=1), "b")],
    ]
    path = str(tmp_path / "late")
    go(state.followed_by(feed(*files), *ARGS), path)
    written = spark.read.parquet(path)
    time_of = F.col("b_ts").cast("timestamp_ntz")
    assert rows(written, "a_id", time_of) == [(1, at(minutes=10)), (1, at(minutes=30)), (5, at(minutes=30))]
    assert rows(state.first_answers(written, "user"), "a_id", time_of) == [(1, at(minutes=10)), (5, at(minutes=30))]
    path = str(tmp_path / "late-miss")
    go(state.not_followed_by(feed(*files), *ARGS), path)
    assert rows(spark.read.parquet(path), "a_id") == [(6,)]


def test_state_is_empty_after_all_expiries(spark, feed, tmp_path):  # noqa: F811
    starts = [(k, f"u{k % 7}", at(minutes=k), "a") for k in range(40)]
    # Rows without a key move the clock of both sides and have no state.
    ends = [(100, None, at(days=2), "a"), (101, None, at(days=2), "b"), (102, "z", at(days=2), "c")]
    for make in (state.followed_by, state.not_followed_by):
        path = str(tmp_path / make.__name__)
        # The last start of each side holds the watermark, so one key stays.
        closing = [(103, "z", at(days=2), "a"), (104, "y", at(days=2), "b")]
        query = go(make(feed(starts, ends, closing), *ARGS), path)
        assert state_rows(query) <= 4


def test_first_days_expire(spark, feed, tmp_path, rows):  # noqa: F811
    day = lambda d, i, u: (i, u, at(days=d, hours=i % 5), "a")
    files = [[day(0, k, f"u{k}") for k in range(20)], [day(1, 30, "u0")], [day(30, 40, "u1")], [day(31, 50, "u1"), day(20, 51, "u2")], [day(20, 60, "u3")]]
    path = str(tmp_path / "days")
    query = sinks.run(state.first_seen(feed(*files), "user", "ts", "id", path, "2 days"), f"{path}-cp", LIMIT)
    got = rows(spark.read.parquet(path), "first_id", "is_first_ever")
    # A batch is held against the watermark of the one before: 60 is late, 51 just not.
    told = [(30, False), (40, True), (50, False), (51, True)]
    assert got == sorted([(k, True) for k in range(20)] + told, key=repr)
    # u1; all others are gone.
    assert state_rows(query) == 1


def test_changes_written_are_no_more_than_keys_changed(spark, feed, tmp_path, rows):  # noqa: F811
    files = [[(k, f"u{k}", at(), "U") for k in range(200)], [(300 + k, "u7", at(), "U") for k in range(50)], [(1, "u7", at(), "U")]]
    stream = feed(*files).select("user", F.col("type").alias("op"), F.col("id").alias("seq"))
    path = str(tmp_path / "changes")
    sinks.run(state.cdc_stream(stream, ["user"], "op", "seq", path), f"{path}-cp", LIMIT)
    sizes = spark.read.parquet(path).groupBy("batch_id").count()
    assert rows(sizes) == [(0, 200), (1, 1), (2, 1)]
    current = state.current_rows(spark, path, stream.schema, ["user"], "op", "seq")
    assert current.count() == 200
    files = len(list(Path(path).rglob("*.parquet")))
    assert files <= 3 * 4


def test_tombstones_are_forgotten(spark, feed, tmp_path, rows):  # noqa: F811
    """State of deleted keys expires by the clock, that of others stays."""
    first = [(5, "gone", at(), "U"), (6, "gone", at(), "D"), (7, "kept", at(), "U"), (9, None, at(), "D")]
    stale = [(4, "gone", at(), "U"), (3, "kept", at(), "U"), (8, None, at(), "U")]
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        for wait, wanted in ((0, [("kept", 7)]), (3, [("gone", 4), ("kept", 7), (None, 8)])):
            folder = tmp_path / f"in-{wait}"
            folder.mkdir()
            path = str(tmp_path / f"forget-{wait}")
            make = lambda: state.cdc_stream(
                spark.readStream.schema("user string, op string, seq bigint").parquet(str(folder)),  # noqa: B023
                ["user"], "op", "seq", path, forget="2 seconds" if wait else "2 days",  # noqa: B023
            )
            for k, part in enumerate((first, stale)):
                frame = spark.createDataFrame([(u, y, i) for i, u, _, y in part], "user string, op string, seq bigint")
                frame.coalesce(1).write.mode("append").parquet(str(folder))
                sinks.run(make(), f"{path}-cp", LIMIT)
                time.sleep(wait if not k else 0)
            written = spark.read.parquet(path)
            if wait:
                # What came after the tombstone was forgotten is there, with its own sequence.
                late = rows(written.where("batch_id = 1"), "user", "seq")
                assert late == [("gone", 4), (None, 8)]
            else:
                assert written.where("batch_id = 1").count() == 0
                current = state.current_rows(spark, path, written.drop("batch_id").schema, ["user"], "op", "seq")
                assert rows(current.withColumn("n", F.lit(7))) == wanted
    finally:
        spark.conf.set(name, before)


def changes_of(spark, folder, *files):
    """A feed of changes (user, at, attr, tie) that delivers the given lists one at a time, in that order."""
    kind = "user string, at timestamp_ntz, attr string, tie int"
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(folder))
        for path in Path(folder).glob("*.parquet"):
            if path not in changes_of.seen:
                changes_of.seen.add(path)
                os.utime(path, (1_700_000_000 + 60 * k,) * 2)
    return event_stream(spark, str(folder), spark.createDataFrame([], kind).schema, "at", max_files=1)


changes_of.seen = set()


def test_enrich_from_feed_in_step(spark, feed, tmp_path, rows):  # noqa: F811
    """Many deliveries on both sides: changes come while events wait for the watermark."""
    changes = [[(f"u{k % 3}", at(minutes=60 * j + 7 * k), f"{(j * k) % 4}", k) for k in range(8)] for j in range(6)]
    events = [[(100 * j + k, f"u{k % 3}", at(minutes=60 * j + 5 * k), "a") for k in range(12)] for j in range(6)]
    close = [[(999, "z", at(days=3), "a")]]
    told = changes_of(spark, tmp_path / "changes", *changes)
    df = state.enrich_from_feed(feed(*events, *close), told, "user", "ts", ["attr"], "at", "tie", "1 minute")
    path = str(tmp_path / "as-of")
    go(df, path)
    data = spark.createDataFrame([e for f in events for e in f], "id bigint, user string, ts timestamp_ntz, type string")
    log = spark.createDataFrame([c for f in changes for c in f], "user string, at timestamp_ntz, attr string, tie int")
    wanted = dim_as_of(data, scd2_build(log, "user", ["attr"], "at", "tie"), "user", "ts")
    columns = ("id", "attr", F.col("valid_from").cast("timestamp_ntz"))
    assert rows(spark.read.schema(df.schema).parquet(path), *columns) == rows(wanted, *columns)


@pytest.mark.parametrize("salts", [1, 3])
def test_enrich_from_feed(spark, feed, tmp_path, rows, salts):  # noqa: F811
    # Changes that change nothing, ties at an instant, changes at an event's own time, keys without changes.
    changes = [(f"u{u}", at(minutes=7 * i + u), "xyy"[(i + u) % 3], i) for u in range(4) for i in range(40)]
    changes += [("u1", at(minutes=50), "p", 1), ("u1", at(minutes=50), "q", 2), ("u2", at(days=-9), "old", 0)]
    changes += [(None, at(), "null", 0), ("u1", None, "null", 0)]
    early = [(k, f"u{k % 6}", at(minutes=2 * k), "a") for k in range(60)]
    late = [(100 + k, f"u{k % 6}", at(minutes=120 + 2 * k), "a") for k in range(60)]
    edge = [(300, None, at(minutes=5), "a"), (301, "u1", None, "b"), (302, "u1", at(minutes=50), None), (303, "u1", at(minutes=50), None)]
    close = [(900, "z", at(days=3), "a")]
    # The feed brings the second hour's changes with the first hour's events, the first hour's one batch behind them.
    second = [c for c in changes if c[1] and c[1] >= at(minutes=120)]
    first = [c for c in changes if c not in second]
    told = changes_of(spark, tmp_path / "changes", second, first)
    stream = feed(early + edge, late, close)
    df = state.enrich_from_feed(stream, told, "user", "ts", ["attr"], "at", "tie", "4 hours", salts)
    path = str(tmp_path / "as-of")
    query = go(df, path)
    read = lambda: spark.read.schema(df.schema).parquet(path)
    data = spark.createDataFrame(early + edge + late, "id bigint, user string, ts timestamp_ntz, type string")
    log = spark.createDataFrame(changes, "user string, at timestamp_ntz, attr string, tie int").where("user IS NOT NULL AND at IS NOT NULL")
    history = scd2_build(log, "user", ["attr"], "at", "tie")
    wanted = dim_as_of(data, history, "user", "ts")
    columns = ("id", "user", "type", "attr", F.col("valid_from").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    assert rows(read(), *columns) == rows(wanted, *columns) and read().count() == 124
    # By key and salt one version before the mark and no event but the last: those of 4 users and of z.
    assert state_rows(query) <= salts * 4 + 4
    forget_last_commit(f"{path}-cp")
    go(df, path)
    assert rows(read(), *columns) == rows(wanted, *columns)


def test_enrich_from_feed_late_change(spark, feed, tmp_path, rows):  # noqa: F811
    """A change behind the watermark holds for what is not out yet, and for nothing that is."""
    other = [("w", at(), "x", 0)]
    told = changes_of(spark, tmp_path / "late", [("u", at(), "x", 0)], other, other, [("u", at(minutes=30), "y", 0)])
    files = [
        [(1, "u", at(hours=1), "a")],
        [(2, "u", at(hours=9), "a")],
        [(3, "v", at(hours=10), "a")],
        [(4, "v", at(days=2), "a")],
    ]
    path = str(tmp_path / "out")
    go(state.enrich_from_feed(feed(*files), told, "user", "ts", ["attr"], "at", "tie", "1 hour"), path)
    got = rows(spark.read.parquet(path), "id", "attr", F.col("valid_from").cast("timestamp_ntz"))
    assert got == [(1, "x", at()), (2, "y", at(minutes=30)), (3, None, None)]


@pytest.mark.parametrize("buckets", [1, 8])
def test_keys_share_values_of_the_state_store(spark, feed, tmp_path, rows, buckets):  # noqa: F811
    """What a batch reads and writes of state goes with buckets, not with keys; results are by key."""
    users = [None, *(f"u{k}" for k in range(60))]
    first = [(k, u, at(minutes=k), "a") for k, u in enumerate(users)]
    second = [(100 + k, u, at(minutes=k + 30 + k % 60), "b") for k, u in enumerate(users)]
    third = [(200 + k, u, at(hours=40, minutes=k), "ab"[k % 2]) for k, u in enumerate(users)]
    files = (first, second, third)
    path = str(tmp_path / "hit")
    query = go(state.followed_by(feed(*files), *ARGS, buckets=buckets), path)
    wanted = [(k, at(minutes=k + 30 + k % 60)) for k in range(1, 61) if 30 + k % 60 <= 60]
    assert rows(spark.read.parquet(path), "a_id", F.col("b_ts").cast("timestamp_ntz")) == sorted(wanted, key=repr)
    assert 0 < state_rows(query) <= buckets
    path = str(tmp_path / "miss")
    query = go(state.not_followed_by(feed(*files), *ARGS, buckets=buckets), path)
    assert rows(spark.read.parquet(path), "a_id") == sorted(((k,) for k in range(1, 61) if 30 + k % 60 > 60), key=repr)
    assert 0 < state_rows(query) <= buckets
    path = str(tmp_path / "days")
    writer = state.first_seen(feed(*files), "user", "ts", "id", path, "2 days", buckets=buckets)
    query = sinks.run(writer, f"{path}-cp", LIMIT)
    told = [(k, True) for k in range(61)] + [(200 + k, False) for k in range(61)]
    assert rows(spark.read.parquet(path), "first_id", "is_first_ever") == sorted(told, key=repr)
    assert 0 < state_rows(query) <= buckets
    log = changes_of(spark, tmp_path / "log", [(u, at(minutes=45), "x", 0) for u in users], [("z", at(), "y", 0)])
    path = str(tmp_path / "as-of")
    df = state.enrich_from_feed(feed(*files, [(900, "z", at(days=9), "a")]), log, "user", "ts", ["attr"], "at", "tie", "2 days", 1, buckets)
    query = go(df, path)
    shown = {r["id"]: r["attr"] for r in spark.read.schema(df.schema).parquet(path).collect()}
    late = lambda i, t: i % 100 > 0 and t >= at(minutes=45)
    assert shown == {i: "x" if late(i, t) else None for f in files for i, _, t, _ in f}
    assert 0 < state_rows(query) <= buckets
