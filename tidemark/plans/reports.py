"""What jobs report of their batches: where messages went, and what became of those that were read.

Both are append-only logs of a few rows per batch, one per topic partition and outcome. A batch that is run again under its name
replaces what its first try reported, so a restart counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.sources import batches

_FOLDED = "folded"


@dataclass(frozen=True)
class DeliveryLog:
    """Delivery reports of publishes: messages per batch, topic, partition and status, with the error of those that failed."""

    spark: SparkSession
    path: str

    SCHEMA = "name string, topic string, partition int, status string, error string, n bigint, max_offset bigint"

    def put(self, messages: DataFrame, batch: str, error: str | None = None) -> None:
        """Reports a batch of messages: as stored, or as handed to a sink that tells no offsets, or failed with an error."""
        known = F.col("offset") if error is None and "offset" in messages.columns else F.lit(None).cast("bigint")
        rows = messages.withColumns({"offset": known, "error": F.lit(error).cast("string")})
        counts = audit.delivery_counts(audit.deliveries(rows))
        batches.append(counts.select(F.lit(batch).alias("name"), *counts.columns).coalesce(1), self.path, batch)

    def read(self) -> DataFrame:
        return batches.read(self.spark, self.path, self.SCHEMA)

    def report(self) -> DataFrame:
        """Per topic, partition and status: messages and the highest offset."""
        return self._folded(self.read(), ["topic", "partition", "status"])

    def compact(self) -> None:
        """Scheduled: the batches but the newest of each job as one, per topic, partition, status and error."""
        _compact(self, lambda rows: self._folded(rows, ["topic", "partition", "status", "error"]))

    def _folded(self, rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("n").alias("n"), F.max("max_offset").alias("max_offset"))


@dataclass(frozen=True)
class Accounts:
    """What a consumer has committed: messages per batch, topic partition and reason, and the highest offset."""

    spark: SparkSession
    path: str

    SCHEMA = "name string, partition int, reason string, n bigint, max_offset bigint"

    def put(self, outcomes: DataFrame, batch: str) -> None:
        """Accounts for all messages of a batch; the last thing a batch does, so that what is here is in the sinks."""
        counts = outcomes.groupBy(F.col("msg_partition").alias("partition"), "reason").agg(
            F.count("*").alias("n"), F.max("msg_offset").alias("max_offset")
        )
        batches.append(counts.select(F.lit(batch).alias("name"), *counts.columns).coalesce(1), self.path, batch)

    def read(self) -> DataFrame:
        return batches.read(self.spark, self.path, self.SCHEMA)

    def report(self) -> DataFrame:
        """Per topic partition: messages read, by their fate, and the offset committed."""
        return audit.landing_counts(self.read())

    def compact(self) -> None:
        """Scheduled: the batches but the newest of each job as one, per partition and reason."""
        _compact(self, self._folded)

    def _folded(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("partition", "reason").agg(F.sum("n").alias("n"), F.max("max_offset").alias("max_offset"))


def _compact(log: DeliveryLog | Accounts, fold: Callable[[DataFrame], DataFrame]) -> None:
    """Rewrites a log; the newest batch of each job stays as it is, because it may be run again under its name."""
    newest: dict[str, int] = {}
    for name in (held := batches.names(log.spark, log.path)):
        job, _, number = name.rpartition("-")
        if number.isdigit():
            newest[job] = max(newest.get(job, -1), int(number))
    open_names = {f"{job}-{number}" for job, number in newest.items()}
    closed = [name for name in held if name not in open_names]
    if len(closed) > 1:
        rows = fold(log.read().filter(~F.col("name").isin(sorted(open_names))))
        batches.rewrite(rows.select(F.lit(_FOLDED).alias("name"), *rows.columns).coalesce(1), log.path, closed)
