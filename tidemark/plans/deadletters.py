"""Dead-letter jobs on an append-only log."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import FeedConfig
from tidemark.operators import deadletter, envelope
from tidemark.plans.reports import DeliveryLog
from tidemark.sources import batches
from tidemark.sources.topic import encode_lines

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Letters:
    """A dead-letter log in a folder. Reading folds it; a put costs what it adds."""

    spark: SparkSession
    path: str

    def log(self) -> DataFrame:
        return batches.read(self.spark, self.path, deadletter.LOG_SCHEMA)

    def read(self) -> DataFrame:
        """The open items."""
        return deadletter.state(self.log())

    def put(self, entries: DataFrame, batch: str | None = None) -> None:
        """Adds entries, combined per item first. A batch put again replaces its first try."""
        batches.append(deadletter.combined(entries), self.path, batch)

    def compact(self) -> None:
        """Scheduled: the log with one entry per open item."""
        old = batches.names(self.spark, self.path)
        if len(old) > 1:
            closed = F.col("reason").isin(deadletter.DELIVERED, deadletter.PURGED)
            batches.rewrite(deadletter.combined(self.log()).filter(~closed), self.path, old)


def purge(letters: Letters, alert_path: str, alert_after: int | None = None) -> None:
    """Writes the alerts, then closes the stale items."""
    concerned = ~F.col("retriable")
    if alert_after is not None:
        concerned = concerned | (F.col("attempts") >= alert_after)
    # the others, most of them in an outage, are neither told of nor closed
    current = letters.read().filter(concerned).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        told = deadletter.alerts(current, alert_after)
        if told.take(1):
            told.coalesce(1).write.mode("append").parquet(alert_path)
        if deadletter.stale(current).take(1):
            letters.put(deadletter.purges(current))
    finally:
        current.unpersist()


def replay(
    letters: Letters,
    cfg: FeedConfig,
    publish: Callable[[DataFrame], DataFrame | None],
    row_schema: T.StructType | None = None,
    keys: Sequence[str] | None = None,
    report: DeliveryLog | None = None,
) -> None:
    """Tries all retriable items again: full checks first, then one publish.

    Delivered items leave. Items that fail a check now stay with that reason and are no
    longer retriable; if publishing fails all valid ones stay with one more attempt. The items tried are kept until
    their outcome is in the log, and the outcome has the text it was found for.
    """
    tried = deadletter.retriable(letters.read()).drop("reason")
    classified = envelope.classify(tried, keys or cfg.keys, row_schema or cfg.row_schema, text="raw", with_value=True, versions=cfg.versions)
    checked = classified.select(*tried.columns, F.col("reason").alias("_found"), "key_text", "value_text")
    checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not checked.take(1):
            return
        messages = encode_lines(checked.filter(F.col("_found") == envelope.OK), cfg)
        delivered, error, stored = True, None, None
        try:
            stored = publish(messages)
        except Exception as e:  # noqa: BLE001 - whatever the sink raises, the items are kept
            delivered, error = False, f"{type(e).__name__}: {e}"
            log.warning("replay of %s is not delivered; the items stay", letters.path, exc_info=True)
        if report is not None:
            report.put(messages if stored is None else stored, f"{cfg.feed}-replay-{uuid.uuid4().hex}", error)
        good = F.lit(None).cast("string") if delivered else F.lit(envelope.UNDELIVERED)
        reason = F.when(F.col("_found") != envelope.OK, F.col("_found")).otherwise(good)
        letters.put(deadletter.outcomes(checked.withColumn("_reason", reason)))
    finally:
        checked.unpersist()
