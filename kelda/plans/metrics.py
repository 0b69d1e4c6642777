"""Registered queries: summaries and metrics."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from kelda.functions.ordered import BUSY

from kelda.functions.times import month_start
from kelda.operators.dims import flatten_dim
from kelda.operators.metrics import (
    cube_sets,
    distinct_bitmap,
    distinct_sketch,
    merge_bitmaps,
    merge_sketches,
    percentiles,
    period_compare,
    pivot,
    running_share,
    subtotals,
    summarize,
    top_k,
    trailing,
    unpivot,
)
from kelda.plans.common import plain, sql_date, sql_time, tables
from kelda.sources.tables import money, net_price


def _region_month(spark, sf_dir):
    orders, customer, nation, region = tables(
        spark, sf_dir, "orders", "customer", "nation", "region"
    )
    geography = flatten_dim(
        customer, (nation, "c_nationkey", "n_nationkey"), (region, "n_regionkey", "r_regionkey")
    ).select("c_custkey", "r_name")
    fact = orders.join(geography, F.col("o_custkey") == F.col("c_custkey"))
    return summarize(
        fact,
        ("month", "o_orderdate"),
        ["r_name"],
        {"revenue": F.sum(money("o_totalprice")), "orders": F.count("*")},
    )


def region_month_revenue(spark, sf_dir):
    return plain(_region_month(spark, sf_dir))


REGION_MONTH = """
SELECT date_trunc('month', o_orderdate) AS period, r_name,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2
"""
REGION_MONTH_SQL = f"""
SELECT {sql_date("period")} AS period, r_name, CAST(revenue AS DOUBLE) AS revenue, orders
FROM ({REGION_MONTH})
"""


def region_month_compare(spark, sf_dir):
    return plain(period_compare(_region_month(spark, sf_dir), "period", "r_name", "revenue"))


COMPARE_SQL = f"""
WITH s AS ({REGION_MONTH})
SELECT c.r_name, {sql_date("c.period")} AS period, CAST(c.revenue AS DOUBLE) AS revenue,
       CAST(p.revenue AS DOUBLE) AS prev_month, CAST(y.revenue AS DOUBLE) AS last_year,
       CAST(c.revenue - p.revenue AS DOUBLE) AS prev_month_change,
       CAST(c.revenue - y.revenue AS DOUBLE) AS last_year_change
FROM s c LEFT JOIN s p ON p.r_name = c.r_name AND p.period = c.period - INTERVAL 1 MONTH
LEFT JOIN s y ON y.r_name = c.r_name AND y.period = c.period - INTERVAL 12 MONTH
"""


def customer_trailing(spark, sf_dir):
    (orders,) = tables(spark, sf_dir, "orders")
    measures = {"amount": money("o_totalprice"), "orders": F.lit(1)}
    return plain(trailing(orders, "o_custkey", "o_orderdate", [1, 7, 30], measures))


def _trailing_sql(n: int) -> str:
    frame = (
        "OVER (PARTITION BY o_custkey ORDER BY day "
        f"RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW)"
    )
    return (
        f"CAST(sum(amount) {frame} AS DOUBLE) AS amount_{n}d, "
        f"CAST(sum(n) {frame} AS BIGINT) AS orders_{n}d"
    )


TRAILING_SQL = f"""
WITH daily AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY 1, 2)
SELECT o_custkey, {sql_date("day")} AS day, {", ".join(_trailing_sql(n) for n in (1, 7, 30))}
FROM daily
"""


def line_subtotals(spark, sf_dir):
    (lineitem,) = tables(spark, sf_dir, "lineitem")
    lines = lineitem.withColumn("ship_year", F.year("l_shipdate"))
    measures = {
        "quantity": ("sum", money("l_quantity")),
        "revenue": ("sum", net_price()),
        "n_lines": ("count", F.lit(1)),
        "first_ship": ("min", F.col("l_shipdate")),
        "last_ship": ("max", F.col("l_shipdate")),
    }
    columns = ["l_returnflag", "l_linestatus", "ship_year"]
    return plain(subtotals(lines, cube_sets(columns), measures))


SUBTOTALS_SQL = f"""
SELECT l_returnflag, l_linestatus, year(l_shipdate) AS ship_year,
       GROUPING(l_returnflag, l_linestatus, year(l_shipdate)) AS level_id,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
       count(*) AS n_lines, {sql_time("min(l_shipdate)")} AS first_ship, {sql_time("max(l_shipdate)")} AS last_ship
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, year(l_shipdate))
"""


def priority_running_share(spark, sf_dir, busy=BUSY):
    (orders,) = tables(spark, sf_dir, "orders")
    rows = orders.select(
        "o_orderpriority", "o_orderdate", "o_orderkey", money("o_totalprice").alias("amount")
    )
    # There are five priorities: days alone would be too few chunks for a large table.
    last_key = orders.agg(F.max("o_orderkey")).scalar()
    chunk = F.struct("o_orderdate", F.floor(F.col("o_orderkey") * 64 / (last_key + 1)))
    order = ["o_orderdate", "o_orderkey"]
    return plain(running_share(rows, "o_orderpriority", order, "amount", chunk, busy))


RUNNING_SQL = f"""
WITH w AS (
  SELECT o_orderpriority, o_orderdate, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
r AS (
  SELECT *, sum(amount) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
                              ROWS UNBOUNDED PRECEDING) AS run,
         sum(amount) OVER (PARTITION BY o_orderpriority) AS tot FROM w)
SELECT o_orderpriority, {sql_time("o_orderdate")} AS o_orderdate, o_orderkey, CAST(amount AS DOUBLE) AS amount,
       CAST(run AS DOUBLE) AS running_total, CAST(tot AS DOUBLE) AS group_total,
       CAST(amount AS DOUBLE) / CAST(tot AS DOUBLE) AS share,
       CAST(run AS DOUBLE) / CAST(tot AS DOUBLE) AS running_share
FROM r
"""


def top_orders(spark, sf_dir):
    """Each priority's ten largest orders."""
    (orders,) = tables(spark, sf_dir, "orders")
    largest = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_first()]
    best = top_k(orders, ["o_orderpriority"], largest, 10)
    return plain(best.select("o_orderpriority", "o_orderkey", "o_totalprice", "place"))


TOP_ORDERS_SQL = """
SELECT o_orderpriority, o_orderkey, o_totalprice, rn AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn
  FROM orders) WHERE rn <= 10
"""


def _largest_parts(spark, sf_dir, ties):
    (part,) = tables(spark, sf_dir, "part")
    best = top_k(part, ["p_brand"], [F.col("p_size").desc_nulls_last()], 3, ties)
    return plain(best.select("p_brand", "p_partkey", "p_size", "place"))


def top_parts_rank(spark, sf_dir):
    return _largest_parts(spark, sf_dir, "rank")


def top_parts_dense(spark, sf_dir):
    return _largest_parts(spark, sf_dir, "dense_rank")


def _top_parts_sql(ties: str) -> str:
    return f"""
SELECT p_brand, p_partkey, CAST(p_size AS BIGINT) AS p_size, rn AS place FROM (
  SELECT *, {ties}() OVER (PARTITION BY p_brand ORDER BY p_size DESC NULLS LAST) AS rn FROM part)
WHERE rn <= 3
"""


STATUSES = ["F", "O", "P"]


def _status_pivot(spark, sf_dir):
    (orders,) = tables(spark, sf_dir, "orders")
    return pivot(orders, ["o_orderpriority"], "o_orderstatus", STATUSES, F.count(F.lit(1)))


def status_pivot(spark, sf_dir):
    return plain(_status_pivot(spark, sf_dir).na.fill(0))


PIVOT_SQL = f"""
SELECT o_orderpriority, {", ".join(f"count(*) FILTER (WHERE o_orderstatus = '{s}') AS {s}" for s in STATUSES)}
FROM orders GROUP BY 1
"""


def status_unpivot(spark, sf_dir):
    wide = _status_pivot(spark, sf_dir).na.fill(0)
    return plain(unpivot(wide, ["o_orderpriority"], STATUSES, "status", "n"))


UNPIVOT_SQL = """
SELECT p.o_orderpriority, s.o_orderstatus AS status, count(o_orderkey) AS n
FROM (SELECT DISTINCT o_orderpriority FROM orders) p
CROSS JOIN (SELECT unnest(['F', 'O', 'P']) AS o_orderstatus) s
LEFT JOIN orders o ON o.o_orderpriority = p.o_orderpriority AND o.o_orderstatus = s.o_orderstatus
GROUP BY 1, 2
"""

POINTS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


def price_percentiles(spark, sf_dir, task_rows=BUSY):
    (lineitem,) = tables(spark, sf_dir, "lineitem")
    return plain(percentiles(lineitem, "l_returnflag", "l_extendedprice", POINTS, task_rows=task_rows))


# By position rather than quantile_cont, whose last bit follows its own order of arithmetic.
PERCENTILES_SQL = f"""
WITH r AS (
  SELECT l_returnflag, l_extendedprice AS v,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS pos,
         count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem),
q AS (SELECT unnest(CAST({POINTS} AS DOUBLE[])) AS p),
lo AS (SELECT l_returnflag, p, v, (n - 1) * p - floor((n - 1) * p) AS part FROM r, q WHERE pos = floor((n - 1) * p)),
hi AS (SELECT l_returnflag, p, v FROM r, q WHERE pos = ceil((n - 1) * p))
SELECT lo.l_returnflag, lo.p, lo.v + (hi.v - lo.v) * part AS value
FROM lo JOIN hi ON lo.l_returnflag = hi.l_returnflag AND lo.p = hi.p
"""


def price_percentiles_approx(spark, sf_dir):
    """Approximate percentiles, and whether their true position is within 0.1 % of the wanted one."""
    (lineitem,) = tables(spark, sf_dir, "lineitem")
    guessed = percentiles(lineitem, "l_returnflag", "l_extendedprice", POINTS, exact=False)
    # One row per return flag.
    guesses = guessed.groupBy("l_returnflag").agg(
        F.map_from_entries(F.collect_list(F.struct("p", "value"))).alias("at")
    )
    below = [F.count_if(F.col("l_extendedprice") < F.col("at")[p]).alias(f"b{i}") for i, p in enumerate(POINTS)]
    upto = [F.count_if(F.col("l_extendedprice") <= F.col("at")[p]).alias(f"u{i}") for i, p in enumerate(POINTS)]
    placed = lineitem.join(guesses, "l_returnflag").groupBy("l_returnflag").agg(F.count("*").alias("n"), *below, *upto)
    slack = F.col("n") * 0.001 + 1
    verdicts = F.array(
        *[
            F.struct(
                F.lit(p).alias("p"),
                ((F.col(f"b{i}") - slack <= F.col("n") * p) & (F.col("n") * p <= F.col(f"u{i}") + slack)).alias("close"),
            )
            for i, p in enumerate(POINTS)
        ]
    )
    return plain(placed.select("l_returnflag", F.explode(verdicts).alias("v")).select("l_returnflag", "v.p", "v.close"))


APPROX_SQL = f"""
SELECT l_returnflag, unnest(CAST({POINTS} AS DOUBLE[])) AS p, true AS close
FROM (SELECT DISTINCT l_returnflag FROM lineitem)
"""


def _parts_by_year(lineitem):
    return lineitem.select("l_partkey", month_start("l_shipdate").alias("month"))


def distinct_parts_sketch(spark, sf_dir):
    """Parts shipped per year from monthly sketches, and whether that is within 5 % of the truth."""
    (lineitem,) = tables(spark, sf_dir, "lineitem")
    monthly = distinct_sketch(_parts_by_year(lineitem), ["month"], "l_partkey")
    yearly = merge_sketches(monthly.withColumn("year", F.year("month")), ["year"])
    exact = (
        _parts_by_year(lineitem)
        .select(F.year("month").alias("year"), "l_partkey")
        .groupBy("year")
        .agg(F.count_distinct("l_partkey").alias("exact"))
    )
    off = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * 0.05 + 1
    return plain(yearly.join(exact, "year").select("year", "exact", off.alias("close")))


SKETCH_SQL = """
SELECT year(l_shipdate) AS year, count(DISTINCT l_partkey) AS exact, true AS close
FROM lineitem GROUP BY 1
"""


def distinct_parts_bitmap(spark, sf_dir):
    """Parts shipped per year, exactly, from monthly bitmaps."""
    (lineitem,) = tables(spark, sf_dir, "lineitem")
    monthly = distinct_bitmap(_parts_by_year(lineitem), ["month"], "l_partkey")
    return plain(merge_bitmaps(monthly.withColumn("year", F.year("month")), ["year"]))


BITMAP_SQL = """
SELECT year(l_shipdate) AS year, count(DISTINCT l_partkey) AS n_distinct FROM lineitem GROUP BY 1
"""

QUERIES = {
    "priority_running_share_busy": partial(priority_running_share, busy=100),
    "price_percentiles_busy": partial(price_percentiles, task_rows=500),
    "region_month_revenue": region_month_revenue,
    "region_month_compare": region_month_compare,
    "customer_trailing": customer_trailing,
    "line_subtotals": line_subtotals,
    "priority_running_share": priority_running_share,
    "top_orders": top_orders,
    "top_parts_rank": top_parts_rank,
    "top_parts_dense": top_parts_dense,
    "status_pivot": status_pivot,
    "status_unpivot": status_unpivot,
    "price_percentiles": price_percentiles,
    "price_percentiles_approx": price_percentiles_approx,
    "distinct_parts_sketch": distinct_parts_sketch,
    "distinct_parts_bitmap": distinct_parts_bitmap,
}
SQL = {
    "priority_running_share_busy": RUNNING_SQL,
    "price_percentiles_busy": PERCENTILES_SQL,
    "region_month_revenue": REGION_MONTH_SQL,
    "region_month_compare": COMPARE_SQL,
    "customer_trailing": TRAILING_SQL,
    "line_subtotals": SUBTOTALS_SQL,
    "priority_running_share": RUNNING_SQL,
    "top_orders": TOP_ORDERS_SQL,
    "top_parts_rank": _top_parts_sql("rank"),
    "top_parts_dense": _top_parts_sql("dense_rank"),
    "status_pivot": PIVOT_SQL,
    "status_unpivot": UNPIVOT_SQL,
    "price_percentiles": PERCENTILES_SQL,
    "price_percentiles_approx": APPROX_SQL,
    "distinct_parts_sketch": SKETCH_SQL,
    "distinct_parts_bitmap": BITMAP_SQL,
}
