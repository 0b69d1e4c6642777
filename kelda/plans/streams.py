"""Registered queries: event streams.

Each query streams the whole table until nothing is left, writes the results to a sink in
the scratch folder and returns what the sink holds. Answers are over what the watermark has
closed by then.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kelda.functions.times import micros
from kelda.operators.dims import flatten_dim, scd2_build
from kelda.plans.common import plain, sql_date, sql_time, tables
from kelda.plans.dims import HISTORY_CTE
from kelda.sources.landing import publish
from kelda.sources.scratch import scratch_path
from kelda.sources.tables import money, schema_of
from kelda.streaming import joins, sinks, state, windows
from kelda.streaming.source import event_stream

DELAY = "1 hour"


#: Deliveries a table is cut into, and inboxes by session, table folder and order.
PARTS = 4
#: Bytes of a delivery's file, about.
FILE_BYTES = 128 << 20
_INBOXES: dict[tuple, str] = {}


def part_of(df, ts):
    """The delivery a row belongs to: the table's days in ``PARTS`` runs of equal length."""
    borders = df.agg(F.to_date(F.min(ts)).alias("first"), F.to_date(F.max(ts)).alias("last"))
    first, last = borders.first()
    if first is None:
        return F.lit(0)
    days = -(-((last - first).days + 1) // PARTS)
    return F.coalesce(F.floor(F.datediff(F.to_date(ts), F.lit(first)) / days), F.lit(0)).cast("int")


def _stream(spark, sf_dir, name, ts, zoned=True, order=range(PARTS)):
    """A table as a stream of several deliveries, one micro-batch for each.

    A delivery is as many files as its size asks for, each written by a task. They are written once a
    session, in the order of ``order``.
    """
    (table,) = tables(spark, sf_dir, name)
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = max(1, -(-size // PARTS // FILE_BYTES))
    key = (spark.sparkContext.applicationId, sf_dir, name, tuple(order))
    if key not in _INBOXES:
        inbox = scratch_path(spark, f"inbox-{name}")
        part = part_of(table, ts)
        for k in order:
            table.where(part == k).repartition(files).write.mode("append").parquet(inbox)
        _INBOXES[key] = inbox
    return event_stream(spark, _INBOXES[key], schema_of(name), ts if zoned else None, max_files=files)


def _events(spark, sf_dir, **options):
    return _stream(spark, sf_dir, "events", "ts", **options)


def _finish(spark, df, name, mode="append"):
    """Run the stream into an idempotent sink; the sink's table."""
    path = scratch_path(spark, name)
    sinks.run(sinks.idempotent_sink(df, path, mode), f"{path}-checkpoint")
    return sinks.read_sink(spark, path, df.schema)


def _value():
    return {"n": F.count("*"), "value": F.sum(money("value"))}


CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"
# Events with the number of their delivery (see ``part_of``).
PARTED_SQL = f"""
SELECT events.*, date_diff('day', d0, CAST(ts AS DATE)) // days AS part
FROM events, (SELECT CAST(min(ts) AS DATE) AS d0,
                     (date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + {PARTS}) // {PARTS} AS days
              FROM events)
"""


def stream_events(spark, sf_dir):
    """The stream as it is, through the replay-safe sink."""
    return plain(_finish(spark, _events(spark, sf_dir), "events"))


STREAM_EVENTS_SQL = f"""
SELECT event_id, {sql_time("ts")} AS ts, user_id, event_type, value, props FROM events
"""


def stream_tumbling(spark, sf_dir):
    """Events per hour and type."""
    counted = windows.tumbling(_events(spark, sf_dir), "ts", "1 hour", DELAY, ["event_type"], _value())
    return plain(_finish(spark, windows.flat(counted), "tumbling"))


TUMBLING_SQL = f"""
SELECT {sql_time("date_trunc('hour', ts)")} AS window_start,
       {sql_time("date_trunc('hour', ts) + INTERVAL 1 HOUR")} AS window_end, event_type, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= {CLOSED}
GROUP BY date_trunc('hour', ts), event_type
"""


def stream_tumbling_late(spark, sf_dir):
    """The same, with the second delivery two batches late: its windows have been closed."""
    events = _events(spark, sf_dir, order=(0, 2, 3, 1))
    counted = windows.tumbling(events, "ts", "1 hour", DELAY, ["event_type"], _value())
    return plain(_finish(spark, windows.flat(counted), "tumbling-late"))


TUMBLING_LATE_SQL = f"""
WITH parted AS ({PARTED_SQL})
SELECT {sql_time("date_trunc('hour', ts)")} AS window_start,
       {sql_time("date_trunc('hour', ts) + INTERVAL 1 HOUR")} AS window_end, event_type, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM parted WHERE part <> 1 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= {CLOSED}
GROUP BY date_trunc('hour', ts), event_type
"""


def stream_sliding(spark, sf_dir):
    """Events in the last six hours, every hour."""
    merge = {"n": F.sum("n"), "value": F.sum("value")}
    counted = windows.sliding(_events(spark, sf_dir), "ts", "6 hours", "1 hour", DELAY, (), _value(), merge)
    return plain(_finish(spark, windows.flat(counted), "sliding"))


SLIDING_SQL = f"""
WITH placed AS (
  SELECT unnest(generate_series(date_trunc('hour', ts) - INTERVAL 5 HOUR, date_trunc('hour', ts), INTERVAL 1 HOUR)) AS s,
         value FROM events)
SELECT {sql_time("s")} AS window_start, {sql_time("s + INTERVAL 6 HOUR")} AS window_end, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM placed WHERE s + INTERVAL 6 HOUR <= {CLOSED} GROUP BY s
"""


def stream_sessions(spark, sf_dir):
    """Sessions per user that end after an hour without events."""
    found = windows.sessions(_events(spark, sf_dir), "user_id", "ts", "1 hour", DELAY, _value())
    return plain(_finish(spark, found, "sessions"))


STREAM_SESSIONS_SQL = f"""
WITH marked AS (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
started AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 3600000000 THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts) AS s FROM marked)
SELECT {sql_time("min(ts)")} AS window_start, {sql_time("max(ts) + INTERVAL 1 HOUR")} AS window_end,
       user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM started GROUP BY user_id, s HAVING max(ts) + INTERVAL 1 HOUR <= {CLOSED}
"""


def stream_rewindow(spark, sf_dir):
    """Days from hours."""
    hourly = windows.tumbling(_events(spark, sf_dir), "ts", "1 hour", DELAY, ["event_type"], _value())
    measures = {"n": F.sum("n"), "value": F.sum("value")}
    daily = windows.rewindow(hourly, "1 day", ["event_type"], measures)
    return plain(_finish(spark, windows.flat(daily), "rewindow"))


# The hourly windows pass on a watermark; a day is out once its last hour is.
REWINDOW_SQL = f"""
SELECT {sql_time("date_trunc('day', ts)")} AS window_start,
       {sql_time("date_trunc('day', ts) + INTERVAL 1 DAY")} AS window_end, event_type, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= {CLOSED}
GROUP BY date_trunc('day', ts), event_type
"""

def stream_split_late(spark, sf_dir):
    """Four deliveries of events, of which the second comes after the third."""
    path = scratch_path(spark, "split")
    stream = _events(spark, sf_dir, order=(0, 2, 1, 3))
    sinks.run(sinks.split_late(stream, "ts", "1 day", path), f"{path}-checkpoint")
    rows = spark.read.parquet(f"{path}/rows").withColumn("late", F.col("late").cast("boolean"))
    return plain(
        rows.groupBy("late", F.to_date("ts").alias("day")).agg(
            F.count("*").alias("n"), F.max("ts").alias("last_ts")
        )
    )


SPLIT_LATE_SQL = f"""
WITH parted AS ({PARTED_SQL}),
parts AS (
  SELECT *, part = 1 AND ts < (SELECT max(ts) - INTERVAL 1 DAY FROM parted WHERE part <= 2) AS late FROM parted)
SELECT late, {sql_date("ts")} AS day, count(*) AS n, {sql_time("max(ts)")} AS last_ts
FROM parts GROUP BY late, {sql_date("ts")}
"""


def stream_dedupe(spark, sf_dir):
    """Events of which purchases are delivered twice, a minute apart."""
    events = _events(spark, sf_dir)
    again = F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    repeated = events.withColumn("copy", F.explode(again))
    repeated = repeated.withColumn("ts", F.timestamp_micros(micros("ts") + F.col("copy") * 60_000_000))
    kept = joins.dedupe(repeated, "event_id", "ts", DELAY)
    return plain(_finish(spark, kept.select("event_id", "event_type"), "dedupe"))


STREAM_DEDUPE_SQL = "SELECT event_id, event_type FROM events"


def stream_enrich(spark, sf_dir):
    """Events with their customer's region."""
    customer, nation, region = tables(spark, sf_dir, "customer", "nation", "region")
    dim = flatten_dim(
        customer, (nation, "c_nationkey", "n_nationkey"), (region, "n_regionkey", "r_regionkey")
    ).select("c_custkey", "c_mktsegment", "r_name")
    joined = joins.enrich(_events(spark, sf_dir), dim, ("user_id", "c_custkey"))
    out = joined.select("event_id", "user_id", "c_mktsegment", "r_name")
    return plain(_finish(spark, out, "enrich"))


STREAM_ENRICH_SQL = """
SELECT event_id, user_id, c_mktsegment, r_name
FROM events LEFT JOIN customer ON user_id = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
"""

# Order dates end before the events begin; this many days bring the history into their month.
SHIFT_DAYS = 8766


def stream_enrich_as_of(spark, sf_dir):
    """Events with the order priority their customer had, histories being moved to 2016 on."""
    (orders,) = tables(spark, sf_dir, "orders")
    moved = orders.select(
        F.col("o_custkey").alias("user_id"),
        "o_orderpriority",
        "o_orderkey",
        F.timestamp_micros(micros("o_orderdate") + SHIFT_DAYS * 86_400_000_000).alias("at"),
    )
    history = publish(
        scd2_build(moved, "user_id", ["o_orderpriority"], "at", "o_orderkey"),
        scratch_path(spark, "history"),
    )
    events = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    path = scratch_path(spark, "enrich-as-of")
    sinks.run(sinks.enrich_as_of(events, history, "user_id", "ts", path), f"{path}-checkpoint")
    return plain(spark.read.parquet(path).drop(sinks.BATCH).select("event_id", "user_id", "o_orderpriority", "valid_from"))


STREAM_AS_OF_SQL = f"""
WITH {HISTORY_CTE},
moved AS (SELECT o_custkey, o_orderpriority, valid_from + INTERVAL {SHIFT_DAYS} DAY AS f,
                 CASE WHEN year(valid_to) = 9999 THEN valid_to ELSE valid_to + INTERVAL {SHIFT_DAYS} DAY END AS t
          FROM history)
SELECT event_id, user_id, o_orderpriority, {sql_time("f")} AS valid_from
FROM events LEFT JOIN moved ON user_id = o_custkey AND ts >= f AND ts < t
"""


#: An order's day is so many seconds of the feed's: their years then are the month of the events.
DAY_SECONDS = 1080


def stream_enrich_from_feed(spark, sf_dir):
    """Events with the order priority their customer had, from a feed of orders that comes beside them."""
    orders = _stream(spark, sf_dir, "orders", "o_orderdate")
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    moved = orders.select(
        F.col("o_custkey").alias("user_id"),
        "o_orderpriority",
        "o_orderkey",
        F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + day * DAY_SECONDS).alias("at"),
    )
    events = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    found = state.enrich_from_feed(events, moved, "user_id", "ts", ["o_orderpriority"], "at", "o_orderkey", DELAY)
    return plain(_finish(spark, found, "enrich-feed").select("event_id", "user_id", "o_orderpriority", "valid_from"))


def _fed(time):
    return f"TIMESTAMP '2024-01-01' + to_seconds({DAY_SECONDS} * date_diff('day', DATE '1995-01-01', CAST({time} AS DATE)))"


STREAM_FEED_SQL = f"""
WITH {HISTORY_CTE},
moved AS (SELECT o_custkey, o_orderpriority, {_fed("valid_from")} AS f, {_fed("valid_to")} AS t FROM history)
SELECT event_id, user_id, o_orderpriority, {sql_time("f")} AS valid_from
FROM events LEFT JOIN moved ON user_id = o_custkey AND ts >= f AND ts < t
WHERE ts < date_trunc('milliseconds', {CLOSED})
"""


def _joined(spark, sf_dir, how, name):
    events = _events(spark, sf_dir)
    views = events.where("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("view_user"), F.col("ts").alias("view_ts")
    )
    buys = events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("buy_id"), F.col("user_id").alias("buy_user"), F.col("ts").alias("buy_ts")
    )
    pairs = joins.interval_join(
        views, buys, ("view_user", "buy_user"), ("view_ts", "buy_ts"), "0 hours", "2 hours", DELAY, how
    )
    return plain(_finish(spark, pairs.select("view_id", "view_ts", "buy_id", "buy_ts"), name))


def stream_interval_join(spark, sf_dir):
    """Views and the same user's purchases within two hours."""
    return _joined(spark, sf_dir, "inner", "interval-join")


def stream_interval_left(spark, sf_dir):
    """The same with views nobody bought after, once that is certain."""
    return _joined(spark, sf_dir, "left_outer", "interval-left")


PAIRS = """
SELECT v.event_id AS view_id, v.ts AS view_ts, b.event_id AS buy_id, b.ts AS buy_ts
FROM (SELECT * FROM events WHERE event_type = 'view') v
{how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
  ON v.user_id = b.user_id AND b.ts >= v.ts AND b.ts <= v.ts + INTERVAL 2 HOUR
"""
INTERVAL_SQL = f"""
SELECT view_id, {sql_time("view_ts")} AS view_ts, buy_id, {sql_time("buy_ts")} AS buy_ts
FROM ({PAIRS.format(how="")})
"""
# The watermark is the lower one of the two sides.
INTERVAL_LEFT_SQL = f"""
WITH closed AS (
  SELECT least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'purchase'))
         - INTERVAL 1 HOUR AS t FROM events)
SELECT view_id, {sql_time("view_ts")} AS view_ts, buy_id, {sql_time("buy_ts")} AS buy_ts
FROM ({PAIRS.format(how="LEFT")}), closed
WHERE buy_id IS NOT NULL OR view_ts + INTERVAL 2 HOUR <= t
"""


def stream_route(spark, sf_dir):
    """Purchases and errors to tables of their own, everything else to a third."""
    path = scratch_path(spark, "route")
    events = _events(spark, sf_dir)
    writer = sinks.route(events, "event_type", ("purchase", "error"), path)
    sinks.run(writer, f"{path}-checkpoint")
    parts = [
        sinks.read_route(spark, path, events.schema, name).select(F.lit(name).alias("routed_to"), "event_type", "value")
        for name in ("purchase", "error", "other")
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return plain(union.groupBy("routed_to", "event_type").agg(*[a.alias(n) for n, a in _value().items()]))


ROUTE_SQL = """
SELECT CASE WHEN event_type IN ('purchase', 'error') THEN event_type ELSE 'other' END AS routed_to, event_type,
       count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1, 2
"""


def stream_cdc(spark, sf_dir):
    """Orders as a change feed on customers; low-priority ones delete."""
    orders = _stream(spark, sf_dir, "orders", "o_orderdate", zoned=False)
    feed = orders.select(
        "o_custkey",
        "o_orderstatus",
        money("o_totalprice").alias("amount"),
        F.when(F.col("o_orderpriority") == "5-LOW", "D").otherwise("U").alias("op"),
        F.col("o_orderkey").alias("seq"),
    )
    path = scratch_path(spark, "cdc")
    sinks.run(state.cdc_stream(feed, ["o_custkey"], "op", "seq", path), f"{path}-checkpoint")
    return plain(state.current_rows(spark, path, feed.schema, ["o_custkey"], "op", "seq"))


STREAM_CDC_SQL = """
SELECT o_custkey, o_orderstatus, o_totalprice AS amount FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1 AND o_orderpriority <> '5-LOW'
"""


def stream_first_seen(spark, sf_dir):
    """Users' first events of each day; after a week away a user counts as new."""
    path = scratch_path(spark, "first-seen")
    writer = state.first_seen(_events(spark, sf_dir), "user_id", "ts", "event_id", path, "7 days")
    sinks.run(writer, f"{path}-checkpoint")
    return plain(spark.read.parquet(path).select("user_id", "first_ts", "first_id", "is_first_ever"))


FIRST_SEEN_SQL = f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS d FROM events),
days AS (
  SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM ranked WHERE d = 1)
SELECT user_id, {sql_time("ts")} AS first_ts, event_id AS first_id,
       before IS NULL OR date_diff('day', before, CAST(ts AS DATE)) - 1 > 7 AS is_first_ever
FROM days
"""


def stream_window_top_k(spark, sf_dir):
    """The three users with the most events in each closed quarter of a day."""
    counted = windows.flat(
        windows.tumbling(_events(spark, sf_dir), "ts", "6 hours", DELAY, ["user_id"])
    )
    path = scratch_path(spark, "top-k")
    order = [F.col("n").desc_nulls_last(), F.col("user_id").asc_nulls_first()]
    sinks.run(sinks.window_top_k(counted, order, 3, path), f"{path}-checkpoint")
    return plain(spark.read.parquet(path).drop(sinks.BATCH))


TOP_K_SQL = f"""
WITH c AS (
  SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS s, user_id, count(*) AS n
  FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY n DESC, user_id) AS place FROM c)
SELECT {sql_time("s")} AS window_start, {sql_time("s + INTERVAL 6 HOUR")} AS window_end, user_id, n, place
FROM r WHERE place <= 3 AND s + INTERVAL 6 HOUR <= {CLOSED}
"""

FOLLOW = ("user_id", "ts", "event_id", "event_type", "view", "purchase", "6 hours", DELAY)


def stream_followed_by(spark, sf_dir):
    """Views the same user's purchase followed within six hours."""
    found = _finish(spark, state.followed_by(_events(spark, sf_dir), *FOLLOW), "followed")
    return plain(state.first_answers(found, "user_id"))


def stream_not_followed_by(spark, sf_dir):
    """Views no purchase of the same user followed within six hours."""
    return plain(_finish(spark, state.not_followed_by(_events(spark, sf_dir), *FOLLOW), "not-followed"))


ANSWERS = """
SELECT v.user_id, v.event_id AS a_id, v.ts AS a_ts, min(b.ts) AS b_ts
FROM (SELECT * FROM events WHERE event_type = 'view') v
LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
  ON v.user_id = b.user_id AND b.ts > v.ts AND b.ts <= v.ts + INTERVAL 6 HOUR
GROUP BY 1, 2, 3
"""
FOLLOWED_SQL = f"""
SELECT user_id, a_id, {sql_time("a_ts")} AS a_ts, {sql_time("b_ts")} AS b_ts
FROM ({ANSWERS}) WHERE b_ts IS NOT NULL
"""
# A view has expired when the watermark, the lower one of both sides, has passed six hours after it.
NOT_FOLLOWED_SQL = f"""
WITH closed AS (
  SELECT least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'purchase'))
         - INTERVAL 1 HOUR AS t FROM events)
SELECT user_id, a_id, {sql_time("a_ts")} AS a_ts FROM ({ANSWERS}), closed
WHERE b_ts IS NULL AND a_ts + INTERVAL 6 HOUR <= t
"""

QUERIES = {
    "stream_events": stream_events,
    "stream_tumbling": stream_tumbling,
    "stream_tumbling_late": stream_tumbling_late,
    "stream_sliding": stream_sliding,
    "stream_sessions": stream_sessions,
    "stream_rewindow": stream_rewindow,
    "stream_split_late": stream_split_late,
    "stream_dedupe": stream_dedupe,
    "stream_enrich": stream_enrich,
    "stream_enrich_as_of": stream_enrich_as_of,
    "stream_enrich_from_feed": stream_enrich_from_feed,
    "stream_interval_join": stream_interval_join,
    "stream_interval_left": stream_interval_left,
    "stream_route": stream_route,
    "stream_cdc": stream_cdc,
    "stream_first_seen": stream_first_seen,
    "stream_window_top_k": stream_window_top_k,
    "stream_followed_by": stream_followed_by,
    "stream_not_followed_by": stream_not_followed_by,
}
SQL = {
    "stream_events": STREAM_EVENTS_SQL,
    "stream_tumbling": TUMBLING_SQL,
    "stream_tumbling_late": TUMBLING_LATE_SQL,
    "stream_sliding": SLIDING_SQL,
    "stream_sessions": STREAM_SESSIONS_SQL,
    "stream_rewindow": REWINDOW_SQL,
    "stream_split_late": SPLIT_LATE_SQL,
    "stream_dedupe": STREAM_DEDUPE_SQL,
    "stream_enrich": STREAM_ENRICH_SQL,
    "stream_enrich_as_of": STREAM_AS_OF_SQL,
    "stream_enrich_from_feed": STREAM_FEED_SQL,
    "stream_interval_join": INTERVAL_SQL,
    "stream_interval_left": INTERVAL_LEFT_SQL,
    "stream_route": ROUTE_SQL,
    "stream_cdc": STREAM_CDC_SQL,
    "stream_first_seen": FIRST_SEEN_SQL,
    "stream_window_top_k": TOP_K_SQL,
    "stream_followed_by": FOLLOWED_SQL,
    "stream_not_followed_by": NOT_FOLLOWED_SQL,
}
