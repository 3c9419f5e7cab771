"""The keyed topic between producer and consumers.

With Spark's Kafka connector on the class path the functions use it. Without it a topic is
a folder of message-shaped rows ``(key, value, topic, partition, offset, timestamp)``.
A message's key is the JSON of the event's key, its value that of the event's value part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import FeedConfig
from tidemark.functions.jsontext import json_bytes
from tidemark.sources import batches

MESSAGE_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def encode(events: DataFrame, topic: str, partitions: int, key: str = "key", value: str = "value") -> DataFrame:
    """Events with struct columns ``key`` and ``value`` as messages.

    Key and value become UTF-8 JSON bytes. A key always goes to the same partition.
    """
    rest = [c for c in events.columns if c not in (key, value)]
    return _messages(events, rest, json_bytes(F.col(key)), json_bytes(F.col(value)), topic, partitions)


def encode_lines(valid: DataFrame, cfg: FeedConfig, key_text: str = "key_text", value_text: str = "value_text") -> DataFrame:
    """Valid classified lines as messages."""
    key, value = F.encode(key_text, "UTF-8"), F.encode(value_text, "UTF-8")
    return _messages(valid, [], key, value, cfg.topic, cfg.topic_partitions)


def _messages(rows: DataFrame, rest: list[str], key: Column, value: Column, topic: str, partitions: int) -> DataFrame:
    return rows.select(
        *rest,
        key.alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int").alias("partition"),
    )


def encode_letters(letters: DataFrame, cfg: FeedConfig) -> DataFrame:
    """Dead-letter puts as messages of the dead-letter topic: item key, and raw text with its reason."""
    value = F.to_json(F.struct("raw", "reason", "attempts"))
    key, value = F.encode("dlq_key", "UTF-8"), F.encode(value, "UTF-8")
    return _messages(letters, [], key, value, cfg.dead_letter_topic, cfg.topic_partitions)


def publish(messages: DataFrame, cfg: FeedConfig, folder: str | None = None, batch: str | None = None) -> DataFrame | None:
    """Appends messages to the topic they name.

    In a folder topic every batch owns a sub-folder. A batch that is repeated under its
    name replaces it and so leaves no second copy; without a name it is an addition. Offsets grow
    within a batch there. Returns the messages as they are stored, with partition and offset; none from Kafka, whose sink tells none.
    """
    if folder is None:
        messages.select("key", "value", "topic").write.format("kafka").options(**cfg.write_options()).save()
        return None
    stamped = messages.withColumns({"offset": F.monotonically_increasing_id(), "timestamp": F.current_timestamp()})
    name = batches.append(stamped, folder, batch)
    return batches.exact(messages.sparkSession, folder, name, T._parse_datatype_string(MESSAGE_SCHEMA))


def subscribe(
    spark: SparkSession, cfg: FeedConfig, folder: str | None = None, max_files: int | None = None, errors: str | None = None
) -> DataFrame:
    """The topic as a stream, from its first message on.

    A folder that another consumer fills may hold what that one was told in place of a message: ``errors`` names the column
    with the code. Spark's own Kafka source has no such rows: it passes partition ends over and fails on errors.
    """
    if folder is None:
        return spark.readStream.format("kafka").options(**cfg.read_options()).load()
    reader = spark.readStream.schema(f"{MESSAGE_SCHEMA}, {f'{errors} string, ' if errors else ''}{batches.BATCH} string")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).drop(batches.BATCH)
