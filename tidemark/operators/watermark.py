"""High-water marks: one row ``(feed_name, last_upd)`` per feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL_SCHEMA = "feed_name string, last_upd bigint"


def marks(control: DataFrame) -> DataFrame:
    """The mark of every feed."""
    return control.groupBy("feed_name").agg(F.max("last_upd").alias("last_upd"))


def mark_of(control: DataFrame, feed: str, default: int = 0) -> int:
    """The mark of one feed; ``default`` for a feed not seen yet. One value comes to the driver."""
    row = control.filter(F.col("feed_name") == feed).agg(F.max("last_upd").alias("last_upd")).first()
    return default if row["last_upd"] is None else row["last_upd"]


def advance(control: DataFrame, seen: DataFrame) -> DataFrame:
    """Control table after a fetch; ``seen`` holds ``(feed_name, last_upd)`` of its events.

    The larger of old and new stays, so an empty fetch or late events never turn a mark
    back. Both sides meet in one aggregate that combines before its shuffle.
    """
    both = control.select("feed_name", "last_upd").unionByName(seen.select("feed_name", "last_upd"))
    return marks(both)


def changed_since(events: DataFrame, time: str | Column, mark) -> DataFrame:
    """Events at or after the mark.

    The bound is inclusive because a feed may hold several events of the mark's instant;
    what is read twice goes in ``changes.dedupe``.
    """
    return events.filter((F.col(time) if isinstance(time, str) else time) >= mark)
