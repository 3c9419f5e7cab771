"""Event time and processing dates.

Feeds carry epoch millis, micros and nanos. Nanos stay bigint: Spark has no timestamp of
that precision and a double loses the last digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without time zone (UTC session)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def millis(ts: str | Column) -> Column:
    """Whole milliseconds since the epoch, rounded down."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def from_millis(ms: str | Column) -> Column:
    return F.timestamp_millis(_col(ms))


def from_micros(us: str | Column) -> Column:
    return F.timestamp_micros(_col(us))


def previous_day(run_date: str | None = None) -> Column:
    """The day before ``run_date`` (``yyyy-MM-dd``), by default the day before today."""
    day = F.current_date() if run_date is None else F.to_date(F.lit(run_date))
    return F.date_sub(day, 1)


def day_label(date: str | Column) -> Column:
    return F.date_format(_col(date), "yyyy-MM-dd")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
