"""Dead letters: keyed put, retry and stale split, alerts, replay, purge.

The store is a log of entries ``(dlq_key, raw, reason, attempts, puts, seen_at)``; what it says together is one row
per ``dlq_key``: the last entry wins. An entry is a put, the outcome of a replay, or a purge; the last two may
close an item. ``attempts`` counts replays, ``puts`` how often the item came in. Undelivered items stay
retriable for as long as it takes; how often they were tried is a matter for alerts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.envelope import UNDELIVERED

LOG_SCHEMA = "dlq_key string, raw string, reason string, attempts int, puts bigint, seen_at timestamp, first_seen timestamp"
STATE_COLUMNS = ("dlq_key", "raw", "reason", "retriable", "attempts", "puts", "first_seen", "last_seen")
# reasons that close an item
DELIVERED, PURGED = "delivered", "purged"


def record_key(raw: str | Column, key_text: str | Column | None = None) -> Column:
    """Record key of the event if it is known, else the digest of the text.

    Later puts of a record replace earlier ones, as in a keyed item store.
    """
    digest = message_key(raw)
    if key_text is None:
        return digest
    return F.coalesce(F.col(key_text) if isinstance(key_text, str) else key_text, digest)


def message_key(raw: str | Column) -> Column:
    """Digest of the text: equal messages share an item, two changes of a record do not."""
    return F.sha2(F.col(raw) if isinstance(raw, str) else raw, 256)


def puts(rows: DataFrame, raw: str, key: Column, reason: str | Column, seen_at: Column | None = None) -> DataFrame:
    """Log entries of quarantined or undelivered rows."""
    now = F.current_timestamp() if seen_at is None else seen_at
    return rows.select(
        key.alias("dlq_key"),
        F.col(raw).alias("raw"),
        (F.col(reason) if isinstance(reason, str) else reason).alias("reason"),
        F.lit(0).alias("attempts"),
        F.lit(1).cast("bigint").alias("puts"),
        now.alias("seen_at"),
        now.alias("first_seen"),
    )


def combined(log: DataFrame) -> DataFrame:
    """The log with one entry per item, closed items included.

    Aggregates before its shuffle, so a text that repeats without end costs one row per task. Of
    entries of one instant an outcome comes after a put, by its attempts.
    """
    last = F.max(F.struct("seen_at", "attempts", "reason", "raw")).alias("_last")
    return (
        log.groupBy("dlq_key")
        .agg(last, F.max("attempts").alias("attempts"), F.sum("puts").alias("puts"), F.min("first_seen").alias("first_seen"))
        .select("dlq_key", "_last.raw", "_last.reason", "attempts", "puts", "_last.seen_at", "first_seen")
    )


def state(log: DataFrame) -> DataFrame:
    """One row per open item."""
    items = combined(log).filter(~F.col("reason").isin(DELIVERED, PURGED))
    retry = F.col("reason") == UNDELIVERED
    return items.withColumnRenamed("seen_at", "last_seen").withColumn("retriable", retry).select(*STATE_COLUMNS)


def retriable(current: DataFrame) -> DataFrame:
    return current.filter("retriable")


def stale(current: DataFrame) -> DataFrame:
    """Items that can never succeed as they are: the checks refuse them."""
    return current.filter("not retriable")


def alerts(current: DataFrame, alert_after: int | None = None) -> DataFrame:
    """What the owning teams are told, per reason, with the oldest item's time.

    Stale items; with ``alert_after`` also those that were replayed that often and are still undelivered.
    """
    told = ~F.col("retriable")
    if alert_after is not None:
        told = told | (F.col("attempts") >= alert_after)
    return current.filter(told).groupBy("reason").agg(F.count("*").alias("n"), F.min("first_seen").alias("oldest"))


def purges(current: DataFrame, now: Column | None = None) -> DataFrame:
    """Entries that close the stale items; undelivered ones are never purged."""
    return _entries(stale(current), F.lit(PURGED), F.col("attempts"), now)


def outcomes(tried: DataFrame, now: Column | None = None) -> DataFrame:
    """Entries after a replay; ``tried`` are items with ``_reason``, null where delivered.

    A delivered item is closed. Another one keeps its text, with one more attempt and the reason found.
    """
    return _entries(tried, F.coalesce("_reason", F.lit(DELIVERED)), F.col("attempts") + 1, now)


def _entries(items: DataFrame, reason: Column, attempts: Column, now: Column | None) -> DataFrame:
    return items.select(
        "dlq_key",
        "raw",
        reason.alias("reason"),
        attempts.cast("int").alias("attempts"),
        F.lit(0).cast("bigint").alias("puts"),
        # never before the entry it answers
        F.greatest(F.current_timestamp() if now is None else now, F.col("last_seen")).alias("seen_at"),
        "first_seen",
    )
