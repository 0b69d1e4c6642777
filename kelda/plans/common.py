"""What the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelda.functions.times import date_text, time_text
from kelda.session import prepare
from kelda.sources.tables import load


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    prepare(spark)
    return [load(spark, sf_dir, name) for name in names]


def plain(df: DataFrame) -> DataFrame:
    """Types every engine shows alike: dates and times as text, whole numbers as bigint,
    decimals as double (after all sums are done)."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = date_text(column)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = time_text(column)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        shown.append(column.alias(field.name))
    return df.select(*shown)


# The same texts in the oracle's SQL.
def sql_date(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def sql_time(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"
