"""Sinks that survive replays, and operators that need a look at whole batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kelda.functions.times import seconds
from kelda.operators.dims import dim_as_of
from kelda.operators.metrics import top_k

BATCH = "batch_id"


def save_batch(batch: DataFrame, batch_id: int, path: str, by: Sequence[str] = ()) -> None:
    """Write a batch under its own id: a replay overwrites it and nothing else."""
    writer = batch.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(f"{path}/{BATCH}={batch_id}")


def idempotent_sink(
    df: DataFrame,
    path: str,
    mode: str = "append",
    change: Callable[[DataFrame], DataFrame] | None = None,
) -> DataStreamWriter:
    """Write a stream to ``path``, one folder per batch; ``change`` is applied to each batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        save_batch(change(batch) if change else batch, batch_id, path)

    return df.writeStream.outputMode(mode).foreachBatch(save)


def run(writer: DataStreamWriter, checkpoint: str, timeout: float | None = None) -> StreamingQuery:
    """Process what is there and stop; with ``timeout`` (seconds), fail if that takes longer."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    return query


def read_sink(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What a sink has written so far, without the batch column."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


ROUTE = "route"


def route(df: DataFrame, by: str, values: Sequence[str], path: str, other: str = "other") -> DataStreamWriter:
    """Split one stream into several tables by the value of ``by``; see ``read_route``.

    Tables are partitions of each batch's folder, so a batch is one write. Values that are not listed, null
    included, go to the table ``other``: together the tables hold the whole input.
    """
    if other in values:
        raise ValueError(f"{other} is the table of all other values")
    to = F.when(F.col(by).isin(*values), F.col(by)).otherwise(F.lit(other))

    def save(batch: DataFrame, batch_id: int) -> None:
        save_batch(batch.withColumn(ROUTE, to), batch_id, path, [ROUTE])

    return df.writeStream.foreachBatch(save)


def read_route(spark: SparkSession, path: str, schema: StructType, table: str) -> DataFrame:
    """One table of ``route``; only its folders are read."""
    full = StructType([*schema.fields, StructField(ROUTE, StringType())])
    return spark.read.schema(full).parquet(path).where(F.col(ROUTE) == table).select(*schema.names)


def split_late(df: DataFrame, ts: str, delay: str, path: str) -> DataStreamWriter:
    """Keep rows that come more than ``delay`` behind the newest row of *earlier* batches.

    Rows go to ``path/rows`` in folders late=true and late=false. The newest time is kept
    per batch id under ``path/marks``, so a replayed batch is split as it was before. It is
    stricter than Spark's own late filter, which looks one batch further back.
    """
    spark = df.sparkSession

    def mark_before(batch_id: int):
        if batch_id == 0:
            return None
        try:
            # Marks are running maxima; the previous batch's is all there is to know.
            return spark.read.parquet(f"{path}/marks/{BATCH}={batch_id - 1}").first()["mark"]
        except AnalysisException:
            marks = spark.read.parquet(f"{path}/marks").where(F.col(BATCH) < batch_id)
            return marks.agg(F.max("mark")).first()[0]

    def save(batch: DataFrame, batch_id: int) -> None:
        mark = mark_before(batch_id)
        limit = F.lit(mark).cast("bigint") - seconds(delay) * 1_000_000
        at = F.unix_micros(ts)
        newest = Observation()
        split = batch.withColumn("late", F.coalesce(at < limit, F.lit(False)))
        save_batch(split.observe(newest, F.max(at).alias("mark")), batch_id, f"{path}/rows", ["late"])
        seen = [m for m in (mark, newest.get["mark"]) if m is not None]
        marks = spark.range(1).select(F.lit(max(seen, default=None)).cast("bigint").alias("mark"))
        save_batch(marks, batch_id, f"{path}/marks")

    return df.writeStream.foreachBatch(save)


def enrich_as_of(df: DataFrame, dim: DataFrame, key: str, ts: str, path: str) -> DataStreamWriter:
    """Attach the dimension version valid at event time and write to ``path``.

    Each batch goes through the batch operator, one ordered pass over events and versions.
    A stream-static range join would compare each event with all versions of its key. Only
    versions of the batch's keys are moved. A batch is as large as the source's limits allow
    (see ``event_stream``), so its keys are not counted first.
    """

    def change(batch: DataFrame) -> DataFrame:
        keys = batch.select(F.col(key).alias("_wanted")).distinct()
        wanted = dim.join(keys, F.col(key) == F.col("_wanted"), "left_semi")
        return dim_as_of(batch, wanted, key, ts, busy=None)

    return idempotent_sink(df, path, change=change)


def window_top_k(
    windowed: DataFrame, order: Sequence[Column], k: int, path: str, ties: str = "row_number"
) -> DataStreamWriter:
    """First k groups of each closed window; ``windowed`` is a flat window aggregate.

    Append mode hands over a window's groups in one batch, when it closes.
    """
    return idempotent_sink(
        windowed, path, change=lambda batch: top_k(batch, ["window_start", "window_end"], order, k, ties)
    )
