"""Event streams from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelda.session import prepare


def event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    ts: str | None = "ts",
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: str | None = None,
    **options: str,
) -> DataFrame:
    """Stream a folder with a fixed schema; ``max_files`` or ``max_bytes`` (such as ``10g``)
    bound what one micro-batch takes in, or else a backlog is a single batch.

    Watermarks need a zoned time, tables hold zone-less ones: ``ts`` is read as UTC.
    """
    prepare(spark)
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    stream = reader.load(path)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")) if ts else stream
