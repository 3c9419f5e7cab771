"""The pipeline as Structured Streaming queries.

Offsets are committed by the checkpoint after ``foreachBatch`` returns. A failed batch is
run again under its old number, and every sink here names its batches by that number, so a repeat
replaces what the first try left. What a batch costs does not depend on what the sinks hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import FeedConfig
from tidemark.operators import changes, deadletter, envelope
from tidemark.plans import intake, landing
from tidemark.plans.deadletters import Letters
from tidemark.plans.merging import Target
from tidemark.plans.reports import Accounts, DeliveryLog
from tidemark.sources import rawzone


def start_intake(
    lines: DataFrame,
    cfg: FeedConfig,
    dead: Letters,
    publish: Callable[[DataFrame, int], DataFrame | None],
    checkpoint: str,
    drain: bool = False,
    report: DeliveryLog | None = None,
) -> StreamingQuery:
    """Feed lines to the topic, faulty or undelivered ones to the dead letters, each batch's deliveries to the report."""

    def batch(rows: DataFrame, number: int) -> None:
        classified = envelope.classify(over_cores(rows.select("line")), cfg.keys, cfg.row_schema, with_value=True, versions=cfg.versions)
        intake.deliver(cfg, classified, dead, lambda m: publish(m, number), f"{cfg.feed}-intake-{number}", report=report)

    return start(lines, batch, cfg, checkpoint, drain)


def start_landing(
    messages: DataFrame,
    cfg: FeedConfig,
    raw_path: str,
    dead: Letters,
    checkpoint: str,
    drain: bool = False,
    once_within: str | None = None,
    errors: str | None = None,
    accounts: Accounts | None = None,
) -> StreamingQuery:
    """Topic messages to the raw zone of the day they are read, faulty ones to the dead letters.

    With ``once_within`` a message that comes again within that much of the topic's time, key and value the same, is left out,
    across micro-batches and restarts: publishing is at least once. The state holds the digests of that
    stretch of time; a message that is later than the stretch is left out as well, so it has to exceed what the topic's time can lag.

    A message is its key and its value; a key that names another row than the image is a fault. Its
    place in the topic goes with the raw row. The date is part of the streaming plan and so comes from the batch's
    own log entry: a batch repeated after midnight still lands in its first day.

    ``errors`` names a column with the code of a consumer's error. Marks of a partition's end are passed over, other errors are
    dead letters that name the place in the topic, and the messages around them land. ``accounts`` get the
    number of messages per partition and fate, after both sinks have the batch.
    """
    writer = f"{cfg.feed}-landing"

    def batch(arrived: DataFrame, number: int) -> None:
        spread = over_cores(arrived) if once_within is None else off_states(arrived, "msg_partition", "msg_offset")
        classified = envelope.classify_messages(spread, cfg.keys, cfg.row_schema, versions=cfg.versions)
        raw = event_text("key", "value")
        if errors is not None:
            classified = envelope.with_errors(classified, errors)
            place = F.to_json(F.struct(F.col(errors).alias("error"), "msg_partition", "msg_offset"))
            raw = F.when(F.col("reason") == envelope.MESSAGE_ERROR, place).otherwise(raw)
        outcomes = landing.outcome(classified, cfg, raw).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = landing.flat_rows(outcomes)
            rawzone.write(rows, raw_path, cfg.raw_format, f"{writer}-{number}", many_days=False)
            bad = envelope.quarantined(outcomes)
            dead.put(deadletter.puts(bad, "raw", deadletter.message_key("raw"), "reason"), f"{writer}-{number}")
            if accounts is not None:
                accounts.put(outcomes, f"{writer}-{number}")
        finally:
            outcomes.unpersist()

    if once_within is not None:
        parts = [F.coalesce(F.hex(c), F.lit("null")) for c in ("key", "value")]
        if errors is not None:  # an error is known by its place, it has nothing else
            parts.append(F.when(F.col(errors).isNotNull(), F.concat_ws("/", errors, "partition", "offset")))
        digest = F.sha2(F.concat_ws("/", *parts), 256)
        messages = changes.dedupe_stream(messages.withColumn("_digest", digest), ["_digest"], "timestamp", once_within)
    dated = messages.select(
        "key", "value", *([errors] if errors is not None else []), F.col("partition").alias("msg_partition"), F.col("offset").alias("msg_offset"), F.current_date().alias(rawzone.DAY)
    )
    return start(dated, batch, cfg, checkpoint, drain)


def start_merge(rows: DataFrame, cfg: FeedConfig, target: Target, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Raw changes into the target: the net changes of each micro-batch are appended."""
    return start(rows, lambda batch, number: target.add(batch, f"{cfg.feed}-merge-{number}"), cfg, checkpoint, drain)


def start(
    rows: DataFrame,
    batch: Callable[[DataFrame, int], None],
    cfg: FeedConfig,
    checkpoint: str,
    drain: bool,
) -> StreamingQuery:
    """Runs ``batch`` per micro-batch: all there is and stop, or one every few seconds for good."""
    writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{cfg.trigger_seconds} seconds").start()


def over_cores(rows: DataFrame) -> DataFrame:
    """A micro-batch that comes in fewer files or topic partitions than there are cores, dealt over all: checks cost far more than a shuffle."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def off_states(rows: DataFrame, *place: str) -> DataFrame:
    """A micro-batch behind a state, which comes in a task per state partition, most of them with hardly any rows: dealt over the cores.

    By the place of a row, which needs no sort, as dealing in turns does.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, *place)


def event_text(key: str, value: str) -> Column:
    """A message as the feed line it would be, which is the form dead letters are replayed in."""
    return F.concat(F.lit('{"key":'), _text_of(key), F.lit(',"value":'), _text_of(value), F.lit("}"))


def _text_of(raw: str) -> Column:
    """Readable text of a bytes column, ``null`` for none; bytes that are not UTF-8 are kept as hex."""
    text = F.col(raw).cast("string")
    return F.coalesce(F.when(F.is_valid_utf8(text), text).otherwise(F.hex(raw)), F.lit("null"))
