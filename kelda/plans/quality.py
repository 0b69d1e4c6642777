"""Registered queries: data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from kelda.operators.quality import (
    check_fk,
    check_rules,
    check_unique,
    check_volume,
    daily_volume,
    reconcile,
    volume_outliers,
)
from kelda.plans.common import plain, sql_date, tables
from kelda.sources.tables import money


def unique_keys(spark, sf_dir):
    orders, lineitem, events = tables(spark, sf_dir, "orders", "lineitem", "events")
    return plain(
        check_unique(orders, ["o_orderkey"], "orders")
        .unionByName(check_unique(lineitem, ["l_orderkey", "l_linenumber"], "lineitem"))
        .unionByName(check_unique(events, ["event_id"], "events"))
    )


def _unique_sql(table: str, keys: str) -> str:
    return f"""
SELECT '{table}' AS "table", 'unique({keys})' AS rule,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS bad_rows,
       CAST(sum(n) AS BIGINT) AS total_rows
FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"""


UNIQUE_SQL = "UNION ALL".join(
    [
        _unique_sql("orders", "o_orderkey"),
        _unique_sql("lineitem", "l_orderkey,l_linenumber"),
        _unique_sql("events", "event_id"),
    ]
)


def line_rules(spark, sf_dir):
    (lineitem,) = tables(spark, sf_dir, "lineitem")
    rules = {
        "quantity set": F.col("l_quantity").isNotNull(),
        "quantity up to 40": F.col("l_quantity").between(1, 40),
        "flag A or N": F.col("l_returnflag").isin("A", "N"),
        "no tax on returns": (F.col("l_returnflag") != "R") | (F.col("l_tax") == 0),
    }
    return plain(check_rules(lineitem, rules, "lineitem"))


RULES_SQL = """
WITH c AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE l_quantity IS NULL) AS b1,
         count(*) FILTER (WHERE l_quantity NOT BETWEEN 1 AND 40) AS b2,
         count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS b3,
         count(*) FILTER (WHERE l_returnflag = 'R' AND l_tax <> 0) AS b4
  FROM lineitem)
SELECT 'lineitem' AS "table", 'quantity set' AS rule, b1 AS bad_rows, total AS total_rows FROM c
UNION ALL SELECT 'lineitem', 'quantity up to 40', b2, total FROM c
UNION ALL SELECT 'lineitem', 'flag A or N', b3, total FROM c
UNION ALL SELECT 'lineitem', 'no tax on returns', b4, total FROM c
"""


def foreign_keys(spark, sf_dir):
    """Two complete references and one to a dimension that lacks a segment."""
    lineitem, orders, customer = tables(spark, sf_dir, "lineitem", "orders", "customer")
    some = customer.where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("other_custkey")
    )
    return plain(
        check_fk(lineitem, orders, ("l_orderkey", "o_orderkey"), "lineitem")
        .unionByName(check_fk(orders, customer, ("o_custkey", "c_custkey"), "orders"))
        .unionByName(check_fk(orders, some, ("o_custkey", "other_custkey"), "orders"))
    )


def _fk_sql(table: str, key: str, rule: str, parent: str) -> str:
    return f"""
SELECT '{table}' AS "table", 'fk({rule})' AS rule,
       count(*) FILTER (WHERE {key} NOT IN (SELECT * FROM ({parent}))) AS bad_rows,
       count(*) AS total_rows FROM {table} """


FK_SQL = "UNION ALL".join(
    [
        _fk_sql("lineitem", "l_orderkey", "l_orderkey->o_orderkey", "SELECT o_orderkey FROM orders"),
        _fk_sql("orders", "o_custkey", "o_custkey->c_custkey", "SELECT c_custkey FROM customer"),
        _fk_sql(
            "orders",
            "o_custkey",
            "o_custkey->other_custkey",
            "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'",
        ),
    ]
)


def reconcile_layers(spark, sf_dir):
    """Orders against the same orders seen from their lines, where those without lines are missing."""
    orders, lineitem = tables(spark, sf_dir, "orders", "lineitem")
    lines = lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    shipped = orders.join(lines, "o_orderkey", "left_semi")
    measures = {
        "amount": (money("o_totalprice"), money("o_totalprice")),
        "nothing": (F.lit(0), F.lit(0)),
    }
    return plain(reconcile(orders, shipped, measures, "orders"))


RECONCILE_SQL = """
WITH t AS (
  SELECT count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders),
s AS (
  SELECT count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT 'orders' AS "table", 'row count' AS rule,
       CAST(t.n <> s.n AS BIGINT) AS bad_rows, t.n AS total_rows FROM t, s
UNION ALL SELECT 'orders', 'sum(amount)', CAST(t.amount <> s.amount AS BIGINT), t.n FROM t, s
UNION ALL SELECT 'orders', 'sum(nothing)', 0, t.n FROM t, s
"""


def event_daily_volume(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    return plain(volume_outliers(daily_volume(events, "ts", 7), 7, 1.5))


VOLUME = """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
days AS (
  SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily),
filled AS (SELECT day, coalesce(n, 0) AS n FROM days LEFT JOIN daily USING (day)),
moved AS (
  SELECT day, n, count(*) OVER w AS d, CAST(sum(n) OVER w AS BIGINT) AS s,
         CAST(sum(n * n) OVER w AS BIGINT) AS q
  FROM filled WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
stats AS (
  SELECT day, n, d AS days_before, CASE WHEN d > 0 THEN CAST(s AS DOUBLE) / d END AS trailing_mean,
         CASE WHEN d > 1 THEN sqrt(CAST(d * q - s * s AS DOUBLE) / (d * (d - 1))) END AS trailing_sd
  FROM moved),
marked AS (
  SELECT *, coalesce(days_before = 7 AND abs(n - trailing_mean) > trailing_sd * 1.5::DOUBLE, false) AS is_bad
  FROM stats)
"""
VOLUME_SQL = f"""{VOLUME}
SELECT {sql_date("day")} AS day, n, days_before, trailing_mean, trailing_sd, is_bad FROM marked
"""


def event_volume_check(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    return plain(check_volume(events, "ts", 7, 1.5, "events"))


VOLUME_CHECK_SQL = f"""{VOLUME}
SELECT 'events' AS "table", 'volume(7d)' AS rule,
       CAST(coalesce(sum(n) FILTER (WHERE is_bad), 0) AS BIGINT) AS bad_rows,
       CAST(sum(n) AS BIGINT) AS total_rows FROM marked
UNION ALL
SELECT 'events', 'has ts', count(*) FILTER (WHERE ts IS NULL), count(*) FROM events
"""

QUERIES = {
    "unique_keys": unique_keys,
    "line_rules": line_rules,
    "foreign_keys": foreign_keys,
    "reconcile_layers": reconcile_layers,
    "event_daily_volume": event_daily_volume,
    "event_volume_check": event_volume_check,
}
SQL = {
    "unique_keys": UNIQUE_SQL,
    "line_rules": RULES_SQL,
    "foreign_keys": FK_SQL,
    "reconcile_layers": RECONCILE_SQL,
    "event_daily_volume": VOLUME_SQL,
    "event_volume_check": VOLUME_CHECK_SQL,
}
