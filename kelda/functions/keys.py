"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(columns: Sequence[str]) -> Column:
    """Distinct keys give distinct texts: each value is preceded by its length, null is N."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(
            F.when(text.isNull(), F.lit("N")).otherwise(
                F.concat(F.lit("V"), F.length(text).cast("string"), F.lit(":"), text)
            )
        )
    return F.concat(*parts)


def key_hash(columns: Sequence[str]) -> Column:
    return F.sha2(key_text(columns), 256)
