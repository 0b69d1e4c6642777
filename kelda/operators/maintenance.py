"""Keeping tables current: upserts, change feeds, snapshot comparison, deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """The row with the highest ``order_by`` per key; the order must be total.

    An aggregate rather than ``row_number() == 1``: copies are thinned out before the
    shuffle, so a key with very many copies is no heavier than any other.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return (
        df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys])
        .agg(F.max_by(row, F.struct(*order_by)).alias("_row"))
        .select("_row.*")
    )


def upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Insert or update by key; the highest ``order_by`` wins, a change wins a tie.

    ``current`` has one row per key; a null key is a key like any other. Both tables are read
    once and stacked: the newest row of a key is one aggregate over both.
    """
    columns = current.columns
    both = current.select(*columns, F.lit(0).alias("_side")).unionByName(
        changes.select(*columns, F.lit(1).alias("_side"))
    )
    return dedupe_latest(both, keys, [*order_by, "_side"]).drop("_side")


def is_deletion(op: str) -> Column:
    """Whether a change deletes; a change without an operation is an update."""
    return F.col(op).eqNullSafe(F.lit("D"))


def apply_cdc(
    base: DataFrame, feed: DataFrame, keys: Sequence[str], op: str, seq: str
) -> DataFrame:
    """Fold an insert/update/delete feed into ``base``: per key the highest ``seq`` counts.

    Keys with changes take the newest one, others keep their row. A null key is a key, a null
    ``op`` an update. Both tables are read once.
    """
    columns = base.columns
    old = base.select(*columns, F.lit(False).alias("_gone"), F.lit(0).alias("_side"), F.lit(None).cast(feed.schema[seq].dataType).alias("_seq"))
    new = feed.select(*columns, is_deletion(op).alias("_gone"), F.lit(1).alias("_side"), F.col(seq).alias("_seq"))
    newest = dedupe_latest(old.unionByName(new), keys, ["_side", "_seq"])
    return newest.where(~F.col("_gone")).select(columns)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key of two snapshots with ``change`` = insert, update, delete or same.

    Both snapshots are stacked and grouped once, which treats null keys and null values
    as equal to themselves.
    """
    values = [c for c in new.columns if c not in keys]
    row = F.struct(*values)
    stacked = old.select(*keys, row.alias("_old"), F.lit(None).cast(_type(new, values)).alias("_new"))
    stacked = stacked.unionByName(
        new.select(*keys, F.lit(None).cast(_type(old, values)).alias("_old"), row.alias("_new"))
    )
    sides = stacked.groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "same")
        .otherwise("update")
    )
    return sides.select(*keys, change.alias("change"))


def _type(df: DataFrame, columns: Sequence[str]) -> T.StructType:
    return T.StructType([df.schema[c] for c in columns])


def json_fields(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """Add a JSON string column's fields as typed columns.

    Extra fields are ignored; text that does not parse goes to ``<col>_corrupt``.
    """
    corrupt = f"{col}_corrupt"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(col, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    return df.withColumn("_parsed", parsed).select(*df.columns, "_parsed.*")
