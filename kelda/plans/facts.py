"""Registered queries: facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from kelda.functions.times import month_start
from kelda.operators.facts import allocate, coverage_gap, milestones, periodic_snapshot, wide_fact
from kelda.operators.skew import salted_join
from kelda.plans.common import plain, sql_date, sql_time, tables
from kelda.sources.tables import money, net_price


def _wide(spark, sf_dir):
    lineitem, orders, customer, part, supplier = tables(
        spark, sf_dir, "lineitem", "orders", "customer", "part", "supplier"
    )
    return wide_fact(
        lineitem,
        orders,
        (customer, "o_custkey", "c_custkey"),
        (part, "l_partkey", "p_partkey"),
        (supplier, "l_suppkey", "s_suppkey"),
    )


def wide_lines(spark, sf_dir):
    return plain(
        _wide(spark, sf_dir).select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_shipdate",
            "o_orderdate",
            "c_mktsegment",
            "p_brand",
            "s_name",
            net_price().alias("net"),
        )
    )


WIDE_SQL = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       {sql_time("l_shipdate")} AS l_shipdate, {sql_time("o_orderdate")} AS o_orderdate,
       c_mktsegment, p_brand, s_name,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
"""


def wide_fact_report(spark, sf_dir):
    """Revenue by segment and brand over the wide fact."""
    return plain(
        _wide(spark, sf_dir)
        .groupBy("c_mktsegment", "p_brand")
        .agg(F.sum(net_price()).alias("revenue"), F.count("*").alias("n_lines"))
    )


WIDE_REPORT_SQL = """
SELECT c_mktsegment, p_brand,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
       count(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2
"""


def customer_month_balance(spark, sf_dir):
    orders, customer = tables(spark, sf_dir, "orders", "customer")
    months = tuple(
        orders.agg(month_start(bound("o_orderdate"))).scalar() for bound in (F.min, F.max)
    )
    return plain(
        periodic_snapshot(
            orders, customer, months, "o_custkey", "c_custkey", "o_orderdate", money("o_totalprice")
        )
    )


BALANCE_SQL = f"""
WITH months AS (
  SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders),
monthly AS (
  SELECT o_custkey, date_trunc('month', o_orderdate) AS m, count(*) AS n,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
  FROM orders GROUP BY 1, 2)
SELECT c_custkey, {sql_date("months.m")} AS month, coalesce(n, 0) AS n,
       CAST(coalesce(amount, 0) AS DOUBLE) AS amount,
       CAST(coalesce(sum(amount) OVER (PARTITION BY c_custkey ORDER BY months.m
            ROWS UNBOUNDED PRECEDING), 0) AS DOUBLE) AS balance
FROM customer CROSS JOIN months
LEFT JOIN monthly ON o_custkey = c_custkey AND monthly.m = months.m
"""


def order_milestones(spark, sf_dir):
    orders, lineitem = tables(spark, sf_dir, "orders", "lineitem")
    return plain(milestones(orders, lineitem))


MILESTONES_SQL = f"""
WITH per_order AS (
  SELECT l_orderkey, min(l_shipdate) AS lo, max(l_shipdate) AS hi, count(*) AS n
  FROM lineitem GROUP BY 1)
SELECT o_orderkey, {sql_time("o_orderdate")} AS o_orderdate, {sql_time("lo")} AS first_ship,
       {sql_time("hi")} AS last_ship, coalesce(n, 0) AS n_lines,
       date_diff('day', o_orderdate, lo) AS days_to_first_ship,
       date_diff('day', o_orderdate, hi) AS days_to_last_ship,
       date_diff('day', lo, hi) AS days_shipping
FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
"""


def idle_customer_quarters(spark, sf_dir):
    """Customer and quarter combinations without an order."""
    orders, customer = tables(spark, sf_dir, "orders", "customer")
    quarter = F.to_date(F.date_trunc("quarter", "o_orderdate"))
    first, last = (orders.agg(bound(quarter)).scalar() for bound in (F.min, F.max))
    quarters = F.sequence(first, last, F.expr("interval 3 months"))
    expected = customer.select("c_custkey", F.explode(quarters).alias("quarter"))
    seen = orders.select(F.col("o_custkey").alias("c_custkey"), quarter.alias("quarter"))
    return plain(coverage_gap(expected, seen, ["c_custkey", "quarter"]))


COVERAGE_SQL = f"""
WITH quarters AS (
  SELECT unnest(generate_series(date_trunc('quarter', min(o_orderdate)),
                                date_trunc('quarter', max(o_orderdate)), INTERVAL 3 MONTH)) AS q FROM orders)
SELECT c_custkey, {sql_date("q")} AS quarter FROM customer CROSS JOIN quarters
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND date_trunc('quarter', o_orderdate) = q)
"""

LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def _allocated(spark, sf_dir):
    lineitem, orders = tables(spark, sf_dir, "lineitem", "orders")
    lines = lineitem.withColumn("weight", money("l_extendedprice"))
    amounts = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), money("o_totalprice").alias("amount")
    )
    return allocate(lines, "amount", "weight", LINE_ORDER, amounts=amounts), amounts


def allocated_lines(spark, sf_dir):
    """Each order's total price split over its lines."""
    lines, _ = _allocated(spark, sf_dir)
    return plain(
        lines.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "allocated"
        )
    )


ALLOCATED_SQL = f"""
WITH lines AS (
  SELECT lineitem.*, CAST(round(o_totalprice * 100) AS HUGEINT) AS a,
         CAST(round(l_extendedprice * 100) AS HUGEINT) AS w
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
shares AS (
  SELECT *, (a * w) // sum(w) OVER (PARTITION BY l_orderkey) AS share,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(c + " DESC" for c in LINE_ORDER)}) AS rn
  FROM lines),
given AS (SELECT *, sum(share) OVER (PARTITION BY l_orderkey) AS given FROM shares)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(share + CASE WHEN rn = 1 THEN a - given ELSE 0 END AS BIGINT) AS DOUBLE) / 100 AS allocated
FROM given
"""


def allocation_check(spark, sf_dir):
    """Orders whose allocated lines do not add up to the amount: none."""
    lines, amounts = _allocated(spark, sf_dir)
    per_order = lines.groupBy("l_orderkey").agg(F.sum("allocated").alias("allocated"))
    return plain(
        per_order.join(amounts, "l_orderkey").agg(
            F.count("*").alias("orders"),
            F.count_if(F.col("amount") != F.col("allocated")).alias("wrong"),
        )
    )


ALLOCATION_CHECK_SQL = """
SELECT count(DISTINCT l_orderkey) AS orders, CAST(0 AS BIGINT) AS wrong
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def salted_customer_join(spark, sf_dir):
    """Orders most of which were put on one customer, joined to customers over eight salts."""
    orders, customer = tables(spark, sf_dir, "orders", "customer")
    key = F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.col("o_custkey"))
    hot = orders.withColumn("c_custkey", key.cast("bigint"))
    joined = salted_join(hot, customer, ["c_custkey"], 8)
    return plain(
        joined.groupBy("c_custkey", "c_mktsegment").agg(
            F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("amount")
        )
    )


SALTED_SQL = """
SELECT c_custkey, c_mktsegment, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END AS k FROM orders)
JOIN customer ON k = c_custkey GROUP BY 1, 2
"""

QUERIES = {
    "wide_lines": wide_lines,
    "wide_fact_report": wide_fact_report,
    "customer_month_balance": customer_month_balance,
    "order_milestones": order_milestones,
    "idle_customer_quarters": idle_customer_quarters,
    "allocated_lines": allocated_lines,
    "allocation_check": allocation_check,
    "salted_customer_join": salted_customer_join,
}
SQL = {
    "wide_lines": WIDE_SQL,
    "wide_fact_report": WIDE_REPORT_SQL,
    "customer_month_balance": BALANCE_SQL,
    "order_milestones": MILESTONES_SQL,
    "idle_customer_quarters": COVERAGE_SQL,
    "allocated_lines": ALLOCATED_SQL,
    "allocation_check": ALLOCATION_CHECK_SQL,
    "salted_customer_join": SALTED_SQL,
}
