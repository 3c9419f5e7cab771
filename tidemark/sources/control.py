"""The control table with the high-water marks of all feeds.

A fetch adds a row ``(feed_name, last_upd)``; the mark of a feed is its largest row. Nothing is read in
order to be written back, so feeds that are fetched at the same time cannot lose each other's marks. Its home is a
JDBC database or a folder.

Beside the marks a folder keeps what a fetch has taken, so that the next one leaves it out: the digests of the lines of
the mark's instant, the digests of all lines that the checks refused (they may have no time to compare with a mark), and the
files that were read. Each fetch that is done adds a row to ``fetches``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.watermark import CONTROL_SCHEMA
from tidemark.sources import batches

SEEN_SCHEMA = "feed_name string, last_upd bigint, digest string"
REFUSED_SCHEMA = "feed_name string, digest string, seen_us bigint"
FILES_SCHEMA = "feed_name string, path string, modified_us bigint, bytes bigint"
FETCHES_SCHEMA = "feed_name string, number bigint"


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The control rows in a database; credentials come in through ``options``."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()


def append_jdbc(seen: DataFrame, url: str, table: str, **options: str) -> None:
    """Adds control rows in a database."""
    seen.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).options(**options).save()


def read(spark: SparkSession, path: str) -> DataFrame:
    """All control rows, none for a new folder."""
    return batches.read(spark, f"{path}/marks", CONTROL_SCHEMA)


def append(seen: DataFrame, path: str, batch: str | None = None) -> None:
    """Adds control rows: one per feed, so one file."""
    batches.append(seen.coalesce(1), f"{path}/marks", batch)


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    return batches.read(spark, f"{path}/seen", SEEN_SCHEMA)


def append_seen(seen: DataFrame, path: str, batch: str | None = None) -> None:
    """Adds digests of lines that were fetched at their feed's mark."""
    batches.append(seen, f"{path}/seen", batch)


def read_refused(spark: SparkSession, path: str) -> DataFrame:
    return batches.read(spark, f"{path}/refused", REFUSED_SCHEMA)


def append_refused(refused: DataFrame, path: str, batch: str | None = None) -> None:
    """Adds digests of refused lines."""
    batches.append(refused, f"{path}/refused", batch)


def forget_refused(spark: SparkSession, path: str, before_us: int) -> None:
    """Scheduled: digests refused before a time go, one folder is left. Such a line is a new one if it comes again."""
    old = batches.names(spark, f"{path}/refused")
    if old:
        batches.rewrite(read_refused(spark, path).filter(F.col("seen_us") >= before_us), f"{path}/refused", old)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return batches.read(spark, f"{path}/files", FILES_SCHEMA)


def append_files(files: DataFrame, path: str, batch: str | None = None) -> None:
    """Adds files that were read: one row each, so one file."""
    batches.append(files.coalesce(1), f"{path}/files", batch)


def fetches(spark: SparkSession, path: str, feed: str) -> int:
    """How many fetches of a feed are done."""
    return batches.read(spark, f"{path}/fetches", FETCHES_SCHEMA).filter(F.col("feed_name") == feed).distinct().count()


def append_fetch(spark: SparkSession, path: str, feed: str, number: int) -> None:
    batches.append(spark.createDataFrame([(feed, number)], FETCHES_SCHEMA).coalesce(1), f"{path}/fetches", f"{feed}-{number}")
