"""Landing raw files (with a side output for broken rows) and publishing partitions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelda.sources.scratch import scratch_path

CORRUPT = "_corrupt"
# Six fraction digits: the default pattern for JSON and CSV keeps milliseconds only.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def split_lines(
    lines: DataFrame, schema: T.StructType, fmt: str, **options: str
) -> tuple[DataFrame, DataFrame]:
    """Parse a ``value`` column of text lines into (good rows, bad lines); every line is in one.

    The text is parsed once, into a stored table of which both outputs are partitions. Blank
    lines are bad. So is a csv line with an open quote, as each half of a record with a quoted
    line break is; see ``land`` for files that have those.
    """
    parse = {"json": F.from_json, "csv": F.from_csv}[fmt]
    settings = _settings(fmt, options)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # from_csv takes its schema as DDL text only.
    target = full if fmt == "json" else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields
    )
    parsed = lines.select("value", parse("value", target, settings).alias("row"))
    broken = F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull() | (F.trim("value") == "")
    if fmt == "csv":
        broken = broken | (_quotes(settings) % 2 == 1)
    return _sorted_out(parsed.withColumn("broken", F.coalesce(broken, F.lit(True))), schema)


def _quotes(settings: dict[str, str], value: str = "value") -> Column:
    """Number of a text's quotes that open or close a value; a doubled one does both."""
    quote, escape = settings["quote"], settings["escape"]
    text = F.col(value)
    if escape != quote:
        text = F.regexp_replace(text, f"(?s){re.escape(escape)}.", "")
    return F.length(text) - F.length(F.replace(text, F.lit(quote)))


def csv_records(spark: SparkSession, path: str, settings: dict[str, str]) -> DataFrame:
    """(file, first, value): the records of csv files, whose quoted values may hold line breaks.

    Files are cut into byte ranges like any text, so one file is many tasks. Whether a range begins
    within quotes follows from the number of quotes in the ranges before it: odd or even, a figure
    for each range. So does, within a range, whether a line begins a record. Lines that are whole
    records stay where they are, others are gathered by the line their record begins with, which may
    be in an earlier range. ``first`` is that line's place (start of its range, and order in it). Quotes
    stand in quoted values only, as standard csv has them.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    counted = lines.withColumn("odd", (_quotes(settings) % 2).cast("int"))
    ranges = counted.groupBy("file", "block").agg((F.sum("odd") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"))
    inside = publish(inside, scratch_path(spark, "csv-ranges"))

    in_range = Window.partitionBy("file", "block").orderBy("place")
    so_far = F.coalesce(F.sum("odd").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = counted.withColumn("place", F.monotonically_increasing_id()).join(inside, ["file", "block"])
    started = ordered.withColumn("starts", (so_far + F.col("inside")) % 2 == 0)
    own = F.when(F.col("starts"), F.struct("block", "place"))
    placed = publish(
        started.withColumn("first", F.last(own, ignorenulls=True).over(in_range)).select(
            "file", "block", "place", "value", "odd", "starts", "first"
        ),
        scratch_path(spark, "csv-lines"),
    )
    whole = F.col("starts") & (F.col("odd") == 0)
    # The record a range begins in the middle of: the last that an earlier range of the file begins.
    last = placed.groupBy("file", "block").agg(F.max("first").alias("last"))
    carried = last.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    carried = publish(carried, scratch_path(spark, "csv-carried"))
    parts = placed.where(~whole).join(carried, ["file", "block"])
    gathered = parts.groupBy("file", F.coalesce("first", "carried").alias("first")).agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("lines")
    )
    joined = gathered.select("file", "first", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value"))
    records = placed.where(whole).select("file", "first", "value").unionByName(joined)
    return records.withColumn("value", F.regexp_replace("value", r"\r\z", ""))


def _settings(fmt: str, options: dict[str, str]) -> dict[str, str]:
    # Standard csv doubles quotes inside quotes; the reader's own default is a backslash.
    standard = {"quote": '"', "escape": '"'} if fmt == "csv" else {}
    return {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "timestampNTZFormat": TIME_FORMAT,
        "timestampFormat": TIME_FORMAT + "XXX",
        **standard,
        **options,
    }


def _sorted_out(parsed: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad lines of (value, row, broken), stored in a folder for each."""
    spark = parsed.sparkSession
    path = scratch_path(spark, "landed")
    # A line's text is needed where it is broken, its values where it isn't.
    row = F.struct(*[F.col(f"row.`{f.name}`") for f in schema.fields])
    kept = parsed.select(
        F.when(F.col("broken"), F.col("value")).alias("line"),
        F.when(~F.col("broken"), row).alias("row"),
        "broken",
    )
    kept.write.partitionBy("broken").parquet(path)
    table = spark.read.schema(kept.schema).parquet(path)
    good = table.where(~F.col("broken")).select(*[F.col(f"row.`{f.name}`") for f in schema.fields])
    return good, table.where("broken").select("line")


def _without_headers(lines: DataFrame, header: str) -> DataFrame:
    """The lines of ``(value, file)`` without one header line of each file.

    Lines equal to the header are all alike, so it does not matter which one goes.
    """
    alike = lines.where(F.col("value") == header).groupBy("file").agg(F.count("*").alias("n"))
    more = alike.where("n > 1").select(F.explode(F.sequence(F.lit(2), F.col("n"))), F.lit(header).alias("value"))
    return lines.where(~F.col("value").eqNullSafe(header)).select("value").unionByName(more.select("value"))


def land(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str,
    header: bool = False,
    multiline: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Read csv or json with a fixed schema; broken records go to a second output.

    A record is a line. With ``header``, each csv file's first line is left out. With
    ``multiline``, csv values in quotes may hold line breaks (see ``csv_records``), and blank lines
    between records are no records.
    """
    if multiline and fmt == "csv":
        records = csv_records(spark, path, _settings(fmt, options)).where(F.trim("value") != "")
        if header:
            heads = records.groupBy(F.col("file").alias("of")).agg(F.min("first").alias("head"))
            heads = publish(heads, scratch_path(spark, "csv-heads"))
            records = records.join(heads, (F.col("file") == F.col("of")) & (F.col("first") == F.col("head")), "left_anti")
        return split_lines(records.select("value"), schema, fmt, multiLine="true", **options)
    lines = spark.read.text(path)
    if header:
        separator = options.get("sep", ",")
        named = lines.select("value", F.col("_metadata.file_path").alias("file"))
        lines = _without_headers(named, separator.join(schema.names))
    return split_lines(lines, schema, fmt, **options)


def write_partitions(df: DataFrame, path: str, by: str | list[str]) -> None:
    """Replace only the partitions present in ``df``; a rerun leaves the same table.

    ``df`` must not read from ``path``. The rebalance hint gathers a partition's rows so
    that files are few, and splits a partition that is far larger than the others.
    """
    by = [by] if isinstance(by, str) else by
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def publish(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write to a new path and read it back: lineage ends in files every executor sees."""
    df.write.mode("errorifexists").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
