"""Registered queries: landing and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelda.operators.maintenance import (
    apply_cdc,
    dedupe_latest,
    json_fields,
    snapshot_diff,
    upsert,
)
from kelda.plans.common import plain, sql_date, sql_time, tables
from kelda.sources.landing import TIME_FORMAT, land, write_partitions
from kelda.sources.scratch import scratch_path
from kelda.sources.tables import money, schema_of

CORRECTED_FROM = "2024-01-20"


def _landed(spark, sf_dir, fmt, multiline=False):
    """Events as text files, landed again.

    Error rows are cut short (to their first value where lines belong together, since an open
    quote would take in the records after it), a blank line follows every sign-up, and payloads hold what csv
    must quote: commas, quotes, and with ``multiline`` line breaks too.
    """
    (events,) = tables(spark, sf_dir, "events")
    schema = schema_of("events")
    note = f', "note": "a,{chr(10) if multiline else " "}b"}}'
    noted = events.withColumn("props", F.regexp_replace("props", r"\}$", note)) if fmt == "csv" else events
    pack = {"json": F.to_json, "csv": F.to_csv}[fmt]
    options = {"timestampNTZFormat": TIME_FORMAT} | ({"escape": '"', "quoteAll": "true"} if fmt == "csv" else {})
    line = pack(F.struct(*schema.names), options)
    short = F.col("event_id").cast("string") if multiline else F.substring(line, 1, 20)
    cut = F.when(F.col("event_type") == "error", short).otherwise(line)
    blank = F.when(F.col("event_type") == "signup", F.array(cut, F.lit(""))).otherwise(F.array(cut))
    path = scratch_path(spark, f"landing-{fmt}")
    noted.select(F.explode(blank).alias("value")).write.text(path)
    good, bad = land(spark, path, schema, fmt, multiline=multiline)
    by_type = good.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.sum(money("value")).alias("value"),
        F.max("ts").alias("last_ts"),
        F.max("props").alias("last_props"),
    )
    broken = bad.agg(F.count("*").alias("n")).select(
        F.lit("(broken)").alias("event_type"),
        "n",
        F.lit(None).cast("decimal(28,2)").alias("value"),
        F.lit(None).cast("timestamp_ntz").alias("last_ts"),
        F.lit(None).cast("string").alias("last_props"),
    )
    return plain(by_type.unionByName(broken))


def _landed_sql(props, blanks):
    return f"""
SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value,
       {sql_time("max(ts)")} AS last_ts, max({props}) AS last_props
FROM events WHERE event_type <> 'error' GROUP BY event_type
UNION ALL
SELECT '(broken)', count(*) FILTER (event_type = 'error') + {blanks}, NULL, NULL, NULL FROM events
"""


BLANKS = "count(*) FILTER (event_type = 'signup')"
LANDED_JSON_SQL = _landed_sql("props", BLANKS)
LANDED_CSV_SQL = _landed_sql("regexp_replace(props, '\\}$', ', \"note\": \"a, b\"}')", BLANKS)
# Between records of several lines a blank line is no record.
LANDED_LINES_SQL = _landed_sql("regexp_replace(props, '\\}$', ', \"note\": \"a,' || chr(10) || 'b\"}')", "0")


def land_json(spark, sf_dir):
    return _landed(spark, sf_dir, "json")


def land_csv(spark, sf_dir):
    return _landed(spark, sf_dir, "csv")


def land_csv_multiline(spark, sf_dir):
    return _landed(spark, sf_dir, "csv", multiline=True)


def replace_partitions(spark, sf_dir):
    """All days are published, then a correction replaces the days it contains, twice."""
    (events,) = tables(spark, sf_dir, "events")
    path = scratch_path(spark, "events-by-day")
    by_day = events.select("event_id", "event_type", "value", F.to_date("ts").alias("day"))
    write_partitions(by_day, path, "day")
    corrected = by_day.where(F.col("day") >= F.lit(CORRECTED_FROM).cast("date")).withColumn(
        "value", F.col("value") * 2
    )
    for _ in range(2):
        write_partitions(corrected, path, "day")
    table = spark.read.schema(by_day.schema).parquet(path)
    return plain(
        table.groupBy("day").agg(F.count("*").alias("n"), F.sum(money("value")).alias("value"))
    )


REPLACED_SQL = f"""
SELECT {sql_date("ts")} AS day, count(*) AS n,
       CAST(sum(CAST(CASE WHEN ts >= '{CORRECTED_FROM}' THEN value * 2 ELSE value END
            AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1
"""


def upsert_orders(spark, sf_dir):
    """Each customer's newest settled order, updated with the pending ones."""
    (orders,) = tables(spark, sf_dir, "orders")
    newest = ["o_orderdate", "o_orderkey"]
    settled = F.col("o_orderstatus") != "P"
    current = dedupe_latest(orders.where(settled), ["o_custkey"], newest)
    return plain(upsert(current, orders.where(~settled), ["o_custkey"], newest))


LATEST_ORDER_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {sql_date("o_orderdate")} || ' 00:00:00.000000'
       AS o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
             ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
"""


def dedupe_orders(spark, sf_dir):
    (orders,) = tables(spark, sf_dir, "orders")
    return plain(dedupe_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))


def cdc_customers(spark, sf_dir):
    """Orders as a change feed on customers; low-priority ones delete."""
    customer, orders = tables(spark, sf_dir, "customer", "orders")
    base = customer.select(
        "c_custkey", F.lit("none").alias("status"), F.lit(0).cast("decimal(18,2)").alias("amount")
    )
    feed = orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("amount"),
        F.when(F.col("o_orderpriority") == "5-LOW", "D").otherwise("U").alias("op"),
        F.col("o_orderkey").alias("seq"),
    )
    return plain(apply_cdc(base, feed, ["c_custkey"], "op", "seq"))


CDC_SQL = """
WITH latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
                 FROM orders) WHERE rn = 1)
SELECT o_custkey AS c_custkey, o_orderstatus AS status, o_totalprice AS amount
FROM latest WHERE o_orderpriority <> '5-LOW'
UNION ALL
SELECT c_custkey, 'none', 0.0::DOUBLE FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM latest)
"""


def snapshot_changes(spark, sf_dir):
    """Two snapshots of customers: segments leave, join, and change their balance."""
    (customer,) = tables(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    balance = F.when(segment == "FURNITURE", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    old = customer.where(segment != "BUILDING")
    new = customer.where(segment != "MACHINERY").withColumn("c_acctbal", balance)
    return plain(snapshot_diff(old, new, ["c_custkey"]))


SNAPSHOT_SQL = """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'insert' WHEN 'MACHINERY' THEN 'delete'
       WHEN 'FURNITURE' THEN 'update' ELSE 'same' END AS change
FROM customer
"""


def event_json_fields(spark, sf_dir):
    (events,) = tables(spark, sf_dir, "events")
    parsed = json_fields(events, "props", T.StructType.fromDDL("k int"))
    return plain(
        parsed.groupBy("event_type", "k").agg(
            F.count("*").alias("n"), F.count("props_corrupt").alias("corrupt")
        )
    )


JSON_SQL = """
SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n,
       CAST(0 AS BIGINT) AS corrupt
FROM events GROUP BY 1, 2
"""

QUERIES = {
    "land_json": land_json,
    "land_csv": land_csv,
    "land_csv_multiline": land_csv_multiline,
    "replace_partitions": replace_partitions,
    "upsert_orders": upsert_orders,
    "cdc_customers": cdc_customers,
    "snapshot_changes": snapshot_changes,
    "dedupe_orders": dedupe_orders,
    "event_json_fields": event_json_fields,
}
SQL = {
    "land_json": LANDED_JSON_SQL,
    "land_csv": LANDED_CSV_SQL,
    "land_csv_multiline": LANDED_LINES_SQL,
    "replace_partitions": REPLACED_SQL,
    "upsert_orders": LATEST_ORDER_SQL,
    "cdc_customers": CDC_SQL,
    "snapshot_changes": SNAPSHOT_SQL,
    "dedupe_orders": LATEST_ORDER_SQL,
    "event_json_fields": JSON_SQL,
}
