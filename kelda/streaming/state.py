"""Change feeds, versions as of an event, first events, and A (not) followed by B: state by key.

State lives in the session's state store (RocksDB), by bucket of keys; the processors are in ``processors``. Each
operator's output is written by batch, so a replayed batch overwrites what it wrote before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from kelda.functions.times import micros, seconds
from kelda.operators.maintenance import dedupe_latest, is_deletion
from kelda.session import ship
from kelda.streaming.processors import GROUP, Answers, FirstDays, Newest, Unanswered, Versions, thin
from kelda.streaming.sinks import idempotent_sink

#: Tasks that rows without a key or a time, which need no state, are spread over.
SPREAD = 1024
#: Buckets of keys: a bucket's keys share a value of the state store (see ``processors.Keyed``).
BUCKETS = 1024
#: Length of the time that one task has of a key, in spans within which an answer counts.
STRETCH = 64


def cdc_stream(
    df: DataFrame, key: Sequence[str], op: str, seq: str, path: str, forget: str | None = None
) -> DataStreamWriter:
    """Write to ``path`` the changes that are newer than all their key had before; older ``seq`` change nothing.

    State is the newest change of each key, an aggregate: changes are thinned out before they are
    shuffled, and a batch writes one row for each key that it has changes of, deletions included, whatever
    the size of the table. It reads nothing of what was written. A null key is a key, a null ``seq``
    the oldest.

    With ``forget`` (such as ``7 days``) state holds the newest ``seq`` only, a deleted key is
    forgotten that long after its deletion, by the clock, and only rows that are newer are written;
    a change older than the deletion that comes later still would bring the key back. Spark then goes on
    with empty batches to let state expire; a stream that is to end by itself must have
    ``spark.sql.streaming.noDataMicroBatches.enabled`` set to false.
    """
    if not forget:
        row = F.struct(*df.columns)
        newest = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in key]).agg(F.max_by(row, F.struct(seq)).alias("_row"))
        return idempotent_sink(newest.select("_row.*"), path, "update")
    ship(df.sparkSession)
    # Plain names for the way through Python.
    names = {c: f"c{k}" for k, c in enumerate(df.columns)}
    marked = df.withColumn("gone", is_deletion(op)).toDF(*names.values(), "gone")
    by = [names[k] for k in key]
    thinned = marked.mapInArrow(thin(by, [names[seq]], last=True), marked.schema)
    processor = Newest(names[seq], "gone", df.schema[seq].dataType.simpleString(), seconds(forget) * 1000)
    newest = thinned.groupBy(*by).transformWithState(processor, marked.schema, "Update", "ProcessingTime")
    return idempotent_sink(newest.drop("gone").toDF(*df.columns), path, "update")


def current_rows(
    spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], op: str, seq: str
) -> DataFrame:
    """The current table of ``cdc_stream``: each key's newest change, deleted keys left out."""
    newest = dedupe_latest(spark.read.schema(schema).parquet(path).select(*schema.names), key, [seq])
    return newest.where(~is_deletion(op)).drop(op, seq)


def enrich_from_feed(
    df: DataFrame,
    changes: DataFrame,
    key: str,
    ts: str,
    attrs: Sequence[str],
    at: str,
    tie: str,
    delay: str,
    salts: int = 1,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Events with the ``attrs`` that their key had at their time, and ``valid_from``, from a stream of changes.

    ``changes`` has ``key``, ``attrs``, the time ``at`` and ``tie``, the highest of which counts at one
    instant. An event is shown once the watermark, ``delay`` behind the newest event, has passed it:
    changes may come before or after their events, by up to ``delay``. The result is then that of
    ``scd2_build`` and ``dim_as_of``. A change that comes later still holds for events that are not
    out yet. Events later than ``delay`` are left out, by Spark's rule, which looks one batch further back.

    State is, by key, the events that wait and the versions they can need: what was valid at the
    watermark and what came after. The dimension is never scanned. Events without a key or
    a time get nulls at once; changes without either hold for nothing. Only events move the watermark, so a
    quiet feed holds nothing up and a backlog of old changes is not late. ``salts`` spreads the events of busy
    keys over more tasks, each of which then has the key's versions. ``buckets`` is how many values of
    the state store hold all keys; it goes with the number of keys, not with that of busy ones.
    """
    ship(df.sparkSession)
    kinds = [*df.schema.fields, *(changes.schema[a] for a in attrs)]
    names = [f"c{k}" for k in range(len(kinds))]
    times = ("timestamp", "timestamp_ntz")

    def packed(column: Column, kind: T.DataType) -> Column:
        return micros(column) if kind.simpleString() in times else column

    def side(rows: DataFrame, event: bool, by: Column, when: Column, tie_of: Column, salt: Column, own: range) -> DataFrame:
        columns = [
            packed(F.col(f"`{f.name}`") if k in own else F.lit(None).cast(f.dataType), f.dataType).alias(n)
            for k, (n, f) in enumerate(zip(names, kinds))
        ]
        marked = when if event else F.lit(None)
        head = [by.alias("key"), salt.alias("salt"), micros(when).alias("at"), tie_of.alias("tie"), F.lit(event).alias("event")]
        return rows.select(*head, *columns, marked.cast("timestamp").alias("mark"))

    n = len(df.columns)
    tie_kind = changes.schema[tie].dataType
    lost = F.col(key).isNull() | F.col(ts).isNull()
    # By all that a row holds; to_json takes maps, which have no hash.
    content = F.xxhash64(F.to_json(F.struct(*(f"`{c}`" for c in df.columns))))
    salt = F.when(lost, -1 - F.pmod(content, F.lit(SPREAD))).otherwise(F.pmod(content, F.lit(salts))).cast("int")
    asked = side(df, True, F.col(key), F.col(ts), F.lit(None).cast(tie_kind), salt, range(n))
    known = changes.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    told = side(known, False, F.col(key).cast(df.schema[key].dataType), F.col(at), F.col(tie), every, range(n, len(kinds)))
    rows = asked.unionByName(told).withWatermark("mark", delay)
    schema = T.StructType(
        [
            *(T.StructField(c, T.LongType() if f.dataType.simpleString() in times else f.dataType) for c, f in zip(names, kinds)),
            T.StructField("since", T.LongType()),
        ]
    )
    processor = Versions([*names, "since"], n, len(attrs))
    found = _bucketed(rows, ["key", "salt"], buckets).transformWithState(processor, schema, "Append", "EventTime")
    time = lambda c, kind: F.timestamp_micros(c).cast(kind)
    shown = [
        (time(c, f.dataType) if f.dataType.simpleString() in times else F.col(c)).alias(f.name) for c, f in zip(names, kinds)
    ]
    return found.select(*shown, time("since", changes.schema[at].dataType).alias("valid_from"))


def first_seen(
    df: DataFrame, key: str, ts: str, id: str, path: str, keep: str | None = None, buckets: int = BUCKETS
) -> DataStreamWriter:
    """Each key's first event per day, as soon as it arrives, under ``path``.

    ``is_first_ever`` marks days of a key before which none is known. With ``keep`` (whole days,
    e.g. ``30 days``) a key that was away for longer counts as new, and state holds only days that a
    later one can be compared with: events more than ``keep`` days and one behind the newest of all are
    late and left out (by Spark's rule, which looks one batch further back), and a key's state goes when it would count as new whatever comes. That is by
    event time, so a replay or a backlog gives the same rows. Without ``keep`` state grows with keys and their days.

    What is written is not taken back: an earlier event of a day that arrives in a later batch changes
    nothing. Nothing that was written is read again. Events are thinned out to one of a key and day
    for each batch of rows before they are shuffled. Rows without a time have no day and are left
    out; a null key is a key.
    """
    ship(df.sparkSession)
    days = seconds(keep) // 86400 if keep else None
    timed = df.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("key"),
        F.unix_date(F.to_date(ts)).alias("day"),
        micros(ts).alias("at"),
        F.col(ts).cast("timestamp").alias("ts"),
        F.col(id).alias("id"),
    )
    thinned = timed.mapInArrow(thin(["key", "day"], ["at", "id"]), timed.schema)
    if keep:
        thinned = thinned.withWatermark("ts", f"{days + 1} days")
    kind = df.schema[id].dataType
    out = T.StructType(
        [
            T.StructField("key", df.schema[key].dataType),
            T.StructField("day", T.IntegerType()),
            T.StructField("at", T.LongType()),
            T.StructField("first_id", kind),
            T.StructField("is_first_ever", T.BooleanType()),
        ]
    )
    told = _bucketed(thinned, ["key"], buckets).transformWithState(
        FirstDays(days), out, "Append", "EventTime" if keep else "None"
    )
    first = F.timestamp_micros("at").cast(df.schema[ts].dataType)
    shown = told.select(
        F.col("key").alias(key),
        first.alias("first_ts"),
        "first_id",
        "is_first_ever",
        F.date_from_unix_date("day").alias("day"),
    )
    return idempotent_sink(shown, path)


def _bucketed(rows: DataFrame, by: Sequence[str], buckets: int):
    """Rows grouped by bucket; what ``by`` holds is in one bucket, whatever else is there."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")).groupBy("bucket")


def _groups(
    df: DataFrame, key: str, ts: str, id: str, type: str, a: str, b: str, within: str, delay: str, salts: int, stretch: int
) -> tuple[DataFrame, list[str], int]:
    """Starts and answers as one stream of (group columns, starts, at, id), and its group columns.

    Both sides have a watermark of their own; the lower one counts. A group is a key's starts of one
    stretch of time, ``stretch`` times ``within`` (a minute at least), with the answers that may be
    theirs: an answer at a border is in two groups. With ``salts`` a group's starts are spread over
    so many, and its answers are in each.
    """
    span = seconds(within) * 1_000_000
    width = max(span * stretch, 60_000_000)
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())

    def side(value: str, starts: bool, bucket: Column, salt: Column) -> DataFrame:
        own = known.where(F.col(type) == value).withWatermark(ts, delay)
        return own.select(
            F.col(key).alias("k0"),
            bucket.alias("k1"),
            ts,
            micros(ts).alias("at"),
            F.lit(starts).alias("starts"),
            F.when(F.lit(starts), F.col(id)).alias("id"),
        ).select("k0", "k1", salt.alias("k2"), ts, "at", "starts", "id")

    at = micros(ts)
    places = F.explode(F.sequence(F.floor((at - span) / width), F.floor((at - 1) / width)))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    asked = side(a, True, F.floor(at / width), F.pmod(F.xxhash64("id", "at"), F.lit(salts)).cast("int"))
    return asked.unionByName(side(b, False, places, every)), list(GROUP), span


def _kinds(df: DataFrame, key: str, id: str, *times: str) -> T.StructType:
    fields = [
        T.StructField("k0", df.schema[key].dataType),
        T.StructField("k1", T.LongType()),
        T.StructField("k2", T.IntegerType()),
        T.StructField("a_id", df.schema[id].dataType),
    ]
    return T.StructType([*fields, *(T.StructField(t, T.LongType()) for t in times)])


def followed_by(
    df: DataFrame,
    key: str,
    ts: str,
    id: str,
    type: str,
    a: str,
    b: str,
    within: str,
    delay: str,
    salts: int = 1,
    stretch: int = STRETCH,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Each A event with the time of the first B of the same key within T after it, when that is there.

    One row for each answered A. Only where a B comes late, behind the one that has been written for an
    A, is there another row with the earlier time: ``first_answers`` takes the first. State holds open
    starts, and answered ones until the watermark has passed their answer. Rows without a key or a
    time follow nothing. State and work of a key are apart for each ``stretch`` times T of its time;
    ``salts`` spreads the starts of very busy keys over more tasks.
    """
    ship(df.sparkSession)
    rows, group, span = _groups(df, key, ts, id, type, a, b, within, delay, salts, stretch)
    found = _bucketed(rows, group, buckets).transformWithState(
        Answers(span), _kinds(df, key, id, "a_at", "b_at"), "Append", "EventTime"
    )
    time = lambda c: F.timestamp_micros(c).cast(df.schema[ts].dataType)
    return found.select(F.col("k0").alias(key), "a_id", time("a_at").alias("a_ts"), time("b_at").alias("b_ts"))


def first_answers(written: DataFrame, key: str) -> DataFrame:
    """Each answered A event with the time of its first B."""
    return written.groupBy(key, "a_id", "a_ts").agg(F.min("b_ts").alias("b_ts"))


def not_followed_by(
    df: DataFrame,
    key: str,
    ts: str,
    id: str,
    type: str,
    a: str,
    b: str,
    within: str,
    delay: str,
    salts: int = 1,
    stretch: int = STRETCH,
    buckets: int = BUCKETS,
) -> DataFrame:
    """A events that no B of the same key followed within T, once the watermark has passed
    their own expiry; arguments as for ``followed_by``. State holds open starts only."""
    ship(df.sparkSession)
    rows, group, span = _groups(df, key, ts, id, type, a, b, within, delay, salts, stretch)
    found = _bucketed(rows, group, buckets).transformWithState(
        Unanswered(span), _kinds(df, key, id, "a_at"), "Append", "EventTime"
    )
    time = F.timestamp_micros("a_at").cast(df.schema[ts].dataType)
    return found.select(F.col("k0").alias(key), "a_id", time.alias("a_ts"))
