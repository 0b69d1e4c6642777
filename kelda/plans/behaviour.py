"""Registered queries: event behaviour in batch."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from kelda.functions.ordered import BUSY

from kelda.operators.behaviour import (
    active_users,
    bounce_rate,
    funnel,
    funnel_counts,
    last_before,
    lifecycle,
    peak_concurrency,
    repeat_rate,
    retention,
    rfm,
    sessionize,
    sessions,
    streaks,
    transitions,
)
from kelda.plans.common import plain, sql_date, sql_time, tables
from kelda.sources.tables import money

GAP = "6 hours"
STEPS = ["view", "click", "purchase"]
WITHIN = "12 hours"


def _sessions(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    measures = {"value": F.sum(money("value"))}
    return sessions(events, "user_id", "ts", GAP, measures)


def user_sessions(spark, sf_dir):
    return plain(_sessions(spark, sf_dir))


SESSIONS = """
marked AS (
  SELECT *, lag(ts) OVER w AS prev FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
started AS (
  SELECT *, max(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 21600000000 THEN ts END)
            OVER (PARTITION BY user_id ORDER BY ts) AS session_start
  FROM marked),
sessions AS (
  SELECT user_id, session_start, max(ts) AS session_end, count(*) AS n_events,
         sum(CAST(value AS DECIMAL(18,2))) AS value
  FROM started GROUP BY 1, 2)
"""
SESSIONS_SQL = f"""
WITH {SESSIONS}
SELECT user_id, {sql_time("session_start")} AS session_start, {sql_time("session_end")} AS session_end,
       n_events, CAST(value AS DOUBLE) AS value
FROM sessions
"""


def event_sessions(spark, sf_dir, busy=BUSY):
    """Every event with its session."""
    (events,) = tables(spark, sf_dir, "events")
    return plain(sessionize(events, "user_id", "ts", GAP, busy=busy).select("event_id", "session_start"))


EVENT_SESSIONS_SQL = f"""
WITH {SESSIONS} SELECT event_id, {sql_time("session_start")} AS session_start FROM started
"""


def daily_active_users(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    return plain(active_users(events, "user_id", "ts", [1, 7, 30]))


def _active_sql(n: int) -> str:
    return (
        "(SELECT count(DISTINCT user_id) FROM events WHERE CAST(ts AS DATE) BETWEEN "
        f"days.day - INTERVAL {n - 1} DAY AND days.day) AS active_{n}d"
    )


ACTIVE_SQL = f"""
WITH days AS (
  SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS day
  FROM events)
SELECT {sql_date("day")} AS day, {", ".join(_active_sql(n) for n in (1, 7, 30))} FROM days
"""


def customer_lifecycle(spark, sf_dir):
    """Life-cycle states of customers by their order days, lapsing after 90 days."""
    (orders,) = tables(spark, sf_dir, "orders")
    return plain(lifecycle(orders, "o_custkey", "o_orderdate", 90))


LIFECYCLE_SQL = f"""
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
n AS (SELECT *, lag(day) OVER w AS prev, lead(day) OVER w AS next FROM d
      WINDOW w AS (PARTITION BY o_custkey ORDER BY day))
SELECT o_custkey, {sql_date("day")} AS day,
       CASE WHEN prev IS NULL THEN 'new' WHEN day - prev <= 90 THEN 'continuing' ELSE 'returned' END AS state
FROM n
UNION ALL
SELECT o_custkey, {sql_date("day + 90")}, 'lapsed' FROM n
WHERE CASE WHEN next IS NULL THEN day + 90 <= (SELECT max(day) FROM d) ELSE next - day > 90 END
"""


def user_retention(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    return plain(retention(events, "user_id", "ts"))


RETENTION_SQL = f"""
WITH f AS (SELECT user_id, CAST(min(ts) AS DATE) AS cohort FROM events GROUP BY 1)
SELECT {sql_date("cohort")} AS cohort, CAST(ts AS DATE) - cohort AS day_offset,
       count(DISTINCT user_id) AS active,
       (SELECT count(*) FROM f g WHERE g.cohort = f.cohort) AS cohort_size
FROM events JOIN f USING (user_id) GROUP BY f.cohort, 2
"""


def user_funnel(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    return plain(funnel(events, "user_id", "ts", "event_type", STEPS, WITHIN))


FUNNEL = """
s1 AS (SELECT user_id, ts FROM events WHERE event_type = 'view'),
s2 AS (SELECT s1.user_id, s1.ts, min(e.ts) AS t2 FROM s1 JOIN events e ON e.user_id = s1.user_id
       AND e.event_type = 'click' AND e.ts > s1.ts AND e.ts <= s1.ts + INTERVAL 12 HOUR GROUP BY 1, 2),
s3 AS (SELECT DISTINCT s2.user_id FROM s2 JOIN events e ON e.user_id = s2.user_id
       AND e.event_type = 'purchase' AND e.ts > t2 AND e.ts <= s2.ts + INTERVAL 12 HOUR),
furthest AS (
  SELECT user_id, CAST(CASE WHEN user_id IN (SELECT user_id FROM s3) THEN 3
                            WHEN user_id IN (SELECT user_id FROM s2) THEN 2 ELSE 1 END AS BIGINT) AS furthest
  FROM (SELECT DISTINCT user_id FROM s1))
"""
FUNNEL_SQL = f"WITH {FUNNEL} SELECT * FROM furthest"


def funnel_report(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    return plain(
        funnel_counts(funnel(events, "user_id", "ts", "event_type", STEPS, WITHIN), STEPS)
    )


FUNNEL_REPORT_SQL = f"""
WITH {FUNNEL}, names(step, name) AS (VALUES (1::BIGINT, 'view'), (2, 'click'), (3, 'purchase'))
SELECT step, name, count(*) AS n FROM names JOIN furthest ON furthest >= step GROUP BY 1, 2
"""


def user_streaks(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    return plain(streaks(events, "user_id", "ts"))


STREAKS_SQL = f"""
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
r AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM d)
SELECT user_id, {sql_date("min(day)")} AS first_day, {sql_date("max(day)")} AS last_day, count(*) AS days
FROM r GROUP BY user_id, run
"""


def event_transitions(spark, sf_dir, busy=BUSY):
    (events,) = tables(spark, sf_dir, "events")
    return plain(transitions(events, "user_id", "ts", "event_type", "event_id", busy=busy))


TRANSITIONS_SQL = """
SELECT from_type, to_type, count(*) AS n FROM (
  SELECT event_type AS from_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS to_type
  FROM events) WHERE to_type IS NOT NULL GROUP BY 1, 2
"""


def click_before_purchase(spark, sf_dir, busy=BUSY):
    """Each purchase with the user's latest click."""
    (events,) = tables(spark, sf_dir, "events")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'")
    found = last_before(purchases, clicks, "user_id", "ts", ["event_id", "ts", "value"], "event_id", busy=busy)
    return plain(found)


LAST_BEFORE_SQL = f"""
SELECT p.event_id, p.user_id, {sql_time("p.ts")} AS ts, c.event_id AS last_event_id,
       {sql_time("c.ts")} AS last_ts, c.value AS last_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
     ON p.user_id = c.user_id AND p.ts >= c.ts
"""


def customer_rfm(spark, sf_dir):
    (orders,) = tables(spark, sf_dir, "orders")
    return plain(rfm(orders, F.lit("2005-01-01").cast("date")))


RFM_SQL = """
WITH c AS (
  SELECT o_custkey, date_diff('day', max(o_orderdate), TIMESTAMP '2005-01-01') AS recency_days,
         count(*) AS frequency, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS monetary
  FROM orders GROUP BY 1)
SELECT o_custkey, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
       ntile(5) OVER (ORDER BY recency_days DESC, o_custkey) AS r_score,
       ntile(5) OVER (ORDER BY frequency, o_custkey) AS f_score,
       ntile(5) OVER (ORDER BY monetary, o_custkey) AS m_score
FROM c
"""


def priority_repeat_rate(spark, sf_dir):
    (orders,) = tables(spark, sf_dir, "orders")
    return plain(repeat_rate(orders, "o_orderpriority"))


REPEAT_SQL = """
SELECT o_orderpriority, count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeaters,
       CAST(count(*) FILTER (WHERE n > 1) AS DOUBLE) / count(*) AS repeat_rate
FROM (SELECT o_orderpriority, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1
"""


def session_bounce_rate(spark, sf_dir):
    by_day = _sessions(spark, sf_dir).withColumn("day", F.to_date("session_start"))
    return plain(bounce_rate(by_day, ["day"]))


BOUNCE_SQL = f"""
WITH {SESSIONS}
SELECT {sql_date("session_start")} AS day, count(*) AS sessions,
       count(*) FILTER (WHERE n_events = 1) AS bounces,
       CAST(count(*) FILTER (WHERE n_events = 1) AS DOUBLE) / count(*) AS bounce_rate
FROM sessions GROUP BY 1
"""


def session_concurrency(spark, sf_dir):
    return plain(peak_concurrency(_sessions(spark, sf_dir), "session_start", "session_end"))


CONCURRENCY_SQL = f"""
WITH {SESSIONS},
moves AS (
  SELECT t, sum(step) AS net FROM (
    SELECT session_start AS t, 1 AS step FROM sessions WHERE session_start < session_end
    UNION ALL SELECT session_end, -1 FROM sessions WHERE session_start < session_end) GROUP BY 1),
days AS (
  SELECT unnest(generate_series(date_trunc('day', min(t)), date_trunc('day', max(t)), INTERVAL 1 DAY)) AS t
  FROM moves),
points AS (
  SELECT t, net FROM moves
  UNION ALL SELECT t, 0 FROM days WHERE t > (SELECT min(t) FROM moves) AND t NOT IN (SELECT t FROM moves)),
counted AS (SELECT t, sum(net) OVER (ORDER BY t) AS n FROM points)
SELECT {sql_date("t")} AS day, CAST(max(n) AS BIGINT) AS peak FROM counted GROUP BY 1
"""

#: Rows of a key from which it is cut into chunks in the variants that show the chunked plan.
FEW = 20

QUERIES = {
    "event_sessions_busy": partial(event_sessions, busy=FEW),
    "event_transitions_busy": partial(event_transitions, busy=FEW),
    "click_before_purchase_busy": partial(click_before_purchase, busy=FEW),
    "user_sessions": user_sessions,
    "event_sessions": event_sessions,
    "daily_active_users": daily_active_users,
    "customer_lifecycle": customer_lifecycle,
    "user_retention": user_retention,
    "user_funnel": user_funnel,
    "funnel_report": funnel_report,
    "user_streaks": user_streaks,
    "event_transitions": event_transitions,
    "click_before_purchase": click_before_purchase,
    "customer_rfm": customer_rfm,
    "priority_repeat_rate": priority_repeat_rate,
    "session_bounce_rate": session_bounce_rate,
    "session_concurrency": session_concurrency,
}
SQL = {
    "event_sessions_busy": EVENT_SESSIONS_SQL,
    "event_transitions_busy": TRANSITIONS_SQL,
    "click_before_purchase_busy": LAST_BEFORE_SQL,
    "user_sessions": SESSIONS_SQL,
    "event_sessions": EVENT_SESSIONS_SQL,
    "daily_active_users": ACTIVE_SQL,
    "customer_lifecycle": LIFECYCLE_SQL,
    "user_retention": RETENTION_SQL,
    "user_funnel": FUNNEL_SQL,
    "funnel_report": FUNNEL_REPORT_SQL,
    "user_streaks": STREAKS_SQL,
    "event_transitions": TRANSITIONS_SQL,
    "click_before_purchase": LAST_BEFORE_SQL,
    "customer_rfm": RFM_SQL,
    "priority_repeat_rate": REPEAT_SQL,
    "session_bounce_rate": BOUNCE_SQL,
    "session_concurrency": CONCURRENCY_SQL,
}
