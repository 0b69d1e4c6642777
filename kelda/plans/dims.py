"""Registered queries: dimensions."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from kelda.functions.ordered import BUSY

from kelda.operators.dims import (
    calendar,
    count_unknown,
    dim_as_of,
    flatten_dim,
    scd2_build,
    scd2_merge,
    surrogate_key,
    unknown_member,
)
from kelda.plans.common import plain, sql_date, sql_time, tables
from kelda.sources.landing import publish
from kelda.sources.scratch import scratch_path


def calendar_of_orders(spark, sf_dir):
    """The calendar the orders span, with each day's order count."""
    (orders,) = tables(spark, sf_dir, "orders")
    span = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    daily = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    days = calendar(span, "lo", "hi").join(daily, "day", "left")
    return plain(days.withColumn("n", F.coalesce("n", F.lit(0))))


CALENDAR_SQL = f"""
WITH days AS (
  SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
  FROM orders),
daily AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT {sql_date("d")} AS day, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
       day(d) AS day_of_month, weekofyear(d) AS iso_week, isodow(d) AS iso_weekday,
       isodow(d) >= 6 AS is_weekend, coalesce(n, 0) AS n
FROM days LEFT JOIN daily USING (d)
"""


def flatten_customer(spark, sf_dir):
    customer, nation, region = tables(spark, sf_dir, "customer", "nation", "region")
    return plain(
        flatten_dim(
            customer,
            (nation, "c_nationkey", "n_nationkey"),
            (region, "n_regionkey", "r_regionkey"),
        )
    )


FLATTEN_SQL = """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
       CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey,
       CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""


def order_surrogate_key(spark, sf_dir):
    (orders,) = tables(spark, sf_dir, "orders")
    keyed = surrogate_key(orders, ["o_custkey", "o_orderkey", "o_orderpriority"])
    return plain(keyed.select("o_orderkey", "sk"))


SURROGATE_SQL = """
SELECT o_orderkey, sha256(
  'V' || length(CAST(o_custkey AS VARCHAR)) || ':' || o_custkey ||
  'V' || length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey ||
  'V' || length(o_orderpriority) || ':' || o_orderpriority) AS sk
FROM orders
"""

HISTORY_ARGS = ("o_custkey", ["o_orderpriority"], "o_orderdate", "o_orderkey")


def priority_history(spark, sf_dir, busy=BUSY):
    """The priority of a customer's orders as an attribute with history."""
    (orders,) = tables(spark, sf_dir, "orders")
    return plain(scd2_build(orders, *HISTORY_ARGS, busy=busy))


HISTORY_CTE = """
settled AS (
  SELECT o_custkey, o_orderdate, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
changed AS (
  SELECT * FROM (
    SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS before
    FROM settled) WHERE before IS NULL OR before <> o_orderpriority),
history AS (
  SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
         coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate),
                  TIMESTAMP '9999-12-31') AS valid_to
  FROM changed)
"""
HISTORY_SQL = f"""
WITH {HISTORY_CTE}
SELECT o_custkey, o_orderpriority, {sql_time("valid_from")} AS valid_from,
       {sql_time("valid_to")} AS valid_to FROM history
"""


def priority_history_merge(spark, sf_dir):
    """The history of all other orders, to which the pending ones (many of them late) are added."""
    (orders,) = tables(spark, sf_dir, "orders")
    late = F.col("o_orderstatus") == "P"
    log = orders.where(~late)
    dim = publish(scd2_build(log, *HISTORY_ARGS), scratch_path(spark, "history"))
    return plain(scd2_merge(dim, log, orders.where(late), *HISTORY_ARGS))


def line_priority_as_of(spark, sf_dir, busy=BUSY):
    """Lines by the priority their customer had on the day of shipping."""
    lineitem, orders = tables(spark, sf_dir, "lineitem", "orders")
    fact = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "o_custkey"
    )
    # A dimension is a stored table by the time facts look things up in it.
    history = publish(scd2_build(orders, *HISTORY_ARGS), scratch_path(spark, "history"))
    found = dim_as_of(fact, history, "o_custkey", "l_shipdate", busy=busy)
    return plain(
        found.groupBy("o_custkey", "o_orderpriority", "valid_from").agg(
            F.count("*").alias("n_lines"), F.max("l_shipdate").alias("last_ship")
        )
    )


AS_OF_SQL = f"""
WITH {HISTORY_CTE},
fact AS (SELECT o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT f.o_custkey, h.o_orderpriority, {sql_time("h.valid_from")} AS valid_from,
       count(*) AS n_lines, {sql_time("max(l_shipdate)")} AS last_ship
FROM fact f LEFT JOIN history h ON f.o_custkey = h.o_custkey
     AND l_shipdate >= h.valid_from AND l_shipdate < h.valid_to
GROUP BY 1, 2, 3
"""


def unknown_customer(spark, sf_dir):
    """Orders against a customer dimension that lacks one segment."""
    orders, customer = tables(spark, sf_dir, "orders", "customer")
    known = customer.where(F.col("c_mktsegment") != "BUILDING")
    resolved = unknown_member(orders, known, "o_custkey", "c_custkey")
    return plain(
        resolved.groupBy("o_custkey", "is_unknown").agg(
            F.count("*").alias("n"), F.count_distinct("o_custkey_source").alias("sources")
        )
    )


UNKNOWN_SQL = """
WITH known AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT coalesce(c_custkey, -1) AS o_custkey, c_custkey IS NULL AS is_unknown, count(*) AS n,
       count(DISTINCT o_custkey) AS sources
FROM orders LEFT JOIN known ON o_custkey = c_custkey GROUP BY 1, 2
"""


def unknown_customer_count(spark, sf_dir):
    orders, customer = tables(spark, sf_dir, "orders", "customer")
    known = customer.where(F.col("c_mktsegment") != "BUILDING")
    return plain(count_unknown(unknown_member(orders, known, "o_custkey", "c_custkey")))


UNKNOWN_COUNT_SQL = """
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE o_custkey NOT IN
         (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')) AS unknown_rows
FROM orders
"""

QUERIES = {
    "priority_history_busy": partial(priority_history, busy=5),
    "line_priority_as_of_busy": partial(line_priority_as_of, busy=20),
    "calendar_of_orders": calendar_of_orders,
    "flatten_customer": flatten_customer,
    "order_surrogate_key": order_surrogate_key,
    "priority_history": priority_history,
    "priority_history_merge": priority_history_merge,
    "line_priority_as_of": line_priority_as_of,
    "unknown_customer": unknown_customer,
    "unknown_customer_count": unknown_customer_count,
}
SQL = {
    "priority_history_busy": HISTORY_SQL,
    "line_priority_as_of_busy": AS_OF_SQL,
    "calendar_of_orders": CALENDAR_SQL,
    "flatten_customer": FLATTEN_SQL,
    "order_surrogate_key": SURROGATE_SQL,
    "priority_history": HISTORY_SQL,
    "priority_history_merge": HISTORY_SQL,
    "line_priority_as_of": AS_OF_SQL,
    "unknown_customer": UNKNOWN_SQL,
    "unknown_customer_count": UNKNOWN_COUNT_SQL,
}
