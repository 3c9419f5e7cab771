"""What a streaming query has committed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_batch(rows: DataFrame, number: int, path: str) -> None:
    """Stores a micro-batch under its number. A repeat replaces the folder of its first try."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={number}")


def committed(rows: DataFrame) -> DataFrame:
    """Per partition: messages committed and the highest offset."""
    return rows.groupBy("partition").agg(F.count("*").alias("n"), F.max("offset").alias("max_offset"))


def progress_rows(query: StreamingQuery) -> list[tuple[int, int]]:
    """``(batch, input rows)`` of the recent micro-batches, for logs and alerts."""
    return [(p.batchId, p.numInputRows) for p in query.recentProgress if p.numInputRows]
