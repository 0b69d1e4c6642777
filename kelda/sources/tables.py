"""The warehouse's source tables and their fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def schema_of(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table; the schema is given, so no file is opened to infer it."""
    return spark.read.schema(schema_of(name)).parquet(f"{sf_dir}/{name}.parquet")


def money(column: str | Column, precision: int = 18, scale: int = 2) -> Column:
    """A double as a decimal, so that sums do not depend on their order."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(T.DecimalType(precision, scale))


def net_price() -> Column:
    """A line's price after discount, exact to four places."""
    return money("l_extendedprice", 14) * (F.lit(1) - money("l_discount", 4))
