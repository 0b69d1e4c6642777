"""Small date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(ts: str | Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a zoned or zone-less time."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def date_text(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def time_text(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def seconds(text: str) -> int:
    """Length of a fixed interval such as ``6 hours`` in seconds."""
    number, unit = text.split()
    unit = unit.rstrip("s")
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
