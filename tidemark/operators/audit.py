"""Counts that have to add up, and delivery reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import DELETE
from tidemark.operators.envelope import BLANK, END, MESSAGE_ERROR, OK


def intake_metrics(reason: str = "reason") -> list[Column]:
    """Read, published, quarantined and blank lines, as aggregates over classified rows."""
    r = F.col(reason)
    return [
        F.count("*").alias("read"),
        F.count_if(r == OK).alias("published"),
        F.count_if(~r.isin(OK, BLANK)).alias("quarantined"),
        F.count_if(r == BLANK).alias("blank"),
    ]


def intake_counts(classified: DataFrame) -> DataFrame:
    """The intake metrics as rows ``(metric, n)``; read = published + quarantined + blank."""
    row = classified.agg(*intake_metrics())
    return _as_rows(row)


def merge_counts(target: DataFrame, net: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a net merge inserts, updates, deletes, and deletes of absent keys it ignores."""
    changed = net.select(*keys, "op")
    matched = target.select(*keys).join(changed, list(keys)).select("op", F.lit(0).alias("_all"), F.lit(1).alias("_hit"))
    seen = changed.select("op", F.lit(1).alias("_all"), F.lit(0).alias("_hit")).unionByName(matched)
    is_delete = F.col("op") == DELETE

    def total(condition: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    return _as_rows(
        seen.agg(
            (total(~is_delete, "_all") - total(~is_delete, "_hit")).alias("inserted"),
            total(~is_delete, "_hit").alias("updated"),
            total(is_delete, "_hit").alias("deleted"),
            (total(is_delete, "_all") - total(is_delete, "_hit")).alias("ignored"),
        )
    )


def delivery_report(deliveries: DataFrame) -> DataFrame:
    """Per topic, partition and status: messages and the highest offset."""
    return deliveries.groupBy("topic", "partition", "status").agg(
        F.count("*").alias("n"), F.max("offset").alias("max_offset")
    )


def delivery_counts(deliveries: DataFrame) -> DataFrame:
    """The report of one publish: also with an error of the messages that failed."""
    return deliveries.groupBy("topic", "partition", "status").agg(
        F.max("error").alias("error"), F.count("*").alias("n"), F.max("offset").alias("max_offset")
    )


def landing_counts(accounts: DataFrame) -> DataFrame:
    """Per topic partition: messages read = landed + refused + blank + ends of the partition + failed, and the offset committed.

    ``accounts`` have ``partition``, ``reason``, ``n`` and ``max_offset``. Marks of a partition's end take no place in the topic.
    """
    reason = F.col("reason")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return accounts.groupBy("partition").agg(
        F.sum("n").alias("read"),
        total(reason == OK).alias("landed"),
        total(~reason.isin(OK, BLANK, END, MESSAGE_ERROR)).alias("refused"),
        total(reason == BLANK).alias("blank"),
        total(reason == END).alias("eof"),
        total(reason == MESSAGE_ERROR).alias("failed"),
        F.max(F.when(reason != END, F.col("max_offset"))).alias("max_offset"),
    )


def deliveries(messages: DataFrame, key: str = "key", error: str = "error") -> DataFrame:
    """One delivery row per message: where it went, or what went wrong."""
    return messages.select(
        "topic",
        "partition",
        "offset",
        F.col(key).cast("string").alias("key"),
        F.when(F.col(error).isNull(), "delivered").otherwise("failed").alias("status"),
        F.col(error).alias("error"),
    )


def _as_rows(row: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("n")) for c in row.columns])
    return row.select(F.inline(pairs))
