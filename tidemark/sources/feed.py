"""The change feed: newline-delimited JSON, one event per line, batch or stream.

A batch fetch lists the files that changed since the newest one taken before, less a margin, and reads those
it has not taken in the state they are in now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.watermark import changed_since

FILE = ("path", "modified_us", "bytes")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines of the feed files as column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def files(spark: SparkSession, path: str, after_us: int | None = None) -> DataFrame:
    """The feed's files ``(path, modified_us, bytes)``, those modified later than a time. No content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if after_us is not None:
        # the option counts in whole seconds of the session's time zone
        bound = spark.range(1).select(F.date_format(F.timestamp_seconds(F.lit(after_us // 1_000_000 - 1)), "yyyy-MM-dd'T'HH:mm:ss"))
        reader = reader.option("modifiedAfter", bound.first()[0])
    return reader.load(path).select("path", F.unix_micros("modificationTime").alias("modified_us"), F.col("length").alias("bytes"))


def untaken(spark: SparkSession, path: str, taken: DataFrame, margin_us: int) -> DataFrame:
    """Files that are new or have changed since they were ``taken``.

    Listed are files modified within ``margin_us`` of the newest one taken, or later: the margin is how late a file may
    show up, or how far clocks may differ. Of the taken files only those of that stretch are looked at.
    """
    newest = taken.agg(F.max("modified_us").alias("t")).first()["t"]
    if newest is None:
        return files(spark, path)
    recent = taken.filter(F.col("modified_us") >= newest - margin_us - 2_000_000).select(*FILE).distinct()
    return files(spark, path, newest - margin_us).join(recent, list(FILE), "left_anti")


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New feed files as they arrive; a new query starts with all files there are."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).withColumnRenamed("value", "line")


def classified_since(classified: DataFrame, mark_ms: int) -> DataFrame:
    """Classified lines whose event time is at or after the mark.

    Lines without a readable event time are kept: they have to reach the quarantine. The time is that
    of the classification, so a line is parsed once.
    """
    return changed_since(classified, F.coalesce("ts_ms", F.lit(mark_ms)), mark_ms)


def read_documents(spark: SparkSession, path: str, schema, multi_line: bool = True) -> DataFrame:
    """JSON documents with a given schema, pretty-printed ones included.

    A pretty-printed file cannot be split: it is one task, so whoever writes such files has to bound
    their size (``maxRecordsPerFile``).
    """
    return spark.read.schema(schema).option("multiLine", multi_line).option("escape", '"').json(path)
