"""Intake: feed lines -> checks -> topic and dead letters -> high-water mark."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import FeedConfig
from tidemark.operators import audit, changes, contract, deadletter, envelope, watermark
from tidemark.plans.deadletters import Letters
from tidemark.plans.reports import DeliveryLog
from tidemark.sources import control, feed
from tidemark.sources.topic import encode_letters, encode_lines

log = logging.getLogger(__name__)
# how late a feed file may show up in a listing, or clocks may differ
MARGIN_US = 10 * 60 * 1_000_000
# what a delivery needs of classified lines
CHECKED = ("line", "reason", "key_text", "value_text", "ts_ms")


def resolve(cfg: FeedConfig, history: DataFrame) -> FeedConfig:
    """The feed's settings with the schemas registered for it: the latest, and all that are in force.

    Looked up once per start; :func:`run` and the streams take the settings as they are.
    """
    return replace(cfg, row_schema=contract.latest_schema(history, cfg.subject), versions=contract.in_force(history, cfg.subject))


@dataclass(frozen=True)
class IntakeResult:
    read: int
    published: int
    quarantined: int
    blank: int
    mark: int | None
    delivered: bool
    error: str | None = None
    files: int | None = None


def fetch(
    spark: SparkSession,
    cfg: FeedConfig,
    feed_path: str,
    control_path: str,
    dead: Letters,
    publish: Callable[[DataFrame], None],
    margin_us: int = MARGIN_US,
    report: DeliveryLog | None = None,
) -> IntakeResult:
    """One fetch of a feed folder: reads the files that are new or have changed since the last one, no others.

    The names of the new files come to the driver, which lists them anyhow. They count as taken once their lines are: a
    fetch that dies reads them again.
    """
    taken = control.read_files(spark, control_path).filter(F.col("feed_name") == cfg.feed)
    new = feed.untaken(spark, feed_path, taken, margin_us).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        paths = [r["path"] for r in new.select("path").distinct().collect()]
        if not paths:
            return IntakeResult(0, 0, 0, 0, None, True, files=0)
        result = run(spark, cfg, feed.read_lines(spark, paths), control_path, dead, publish, report)
        control.append_files(new.select(F.lit(cfg.feed).alias("feed_name"), *feed.FILE), control_path)
        return replace(result, files=len(paths))
    finally:
        new.unpersist()


def run(
    spark: SparkSession,
    cfg: FeedConfig,
    lines: DataFrame,
    control_path: str,
    dead: Letters,
    publish: Callable[[DataFrame], DataFrame | None],
    report: DeliveryLog | None = None,
) -> IntakeResult:
    """One fetch of lines: everything since the mark, and the mark moves once both sinks are done.

    The bound is inclusive. Lines of the mark's instant that an earlier fetch has taken are known by their
    digests and left out, and so are lines that were refused before, which may have no time: an item that was purged
    stays closed however often its line comes. A line that is there twice goes out once. A feed is fetched by one job at a time; a
    fetch that is run again after it died replaces the letters of its first try.
    """
    mark = watermark.mark_of(control.read(spark, control_path), cfg.feed)
    number = control.fetches(spark, control_path, cfg.feed)
    classified = envelope.classify(lines.select("line"), cfg.keys, cfg.row_schema, with_value=True, versions=cfg.versions, since_ms=mark)
    since = feed.classified_since(classified, mark).withColumn("digest", deadletter.message_key("line"))
    since = since.select("line", "reason", "key_text", "value_text", "ts_ms", "digest", F.monotonically_increasing_id().alias("_place"))
    since = since.persist(StorageLevel.MEMORY_AND_DISK)
    # small, and stored first, so that Spark knows and leaves the lines where they are
    repeated = changes.repeats(since, "digest", "_place").persist(StorageLevel.MEMORY_AND_DISK)
    known = _known(spark, cfg, control_path, since, mark).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        repeated.count(), known.count()
        kept = changes.without_repeats(since, repeated, "digest", "_place").join(known, "digest", "left_anti")
        result = deliver(cfg, kept, dead, publish, f"{cfg.feed}-fetch-{number}", report=report)
        own = F.lit(cfg.feed).alias("feed_name")
        # first the digests: without the mark they do no harm
        refused = envelope.quarantined(kept).select(own, "digest", F.unix_micros(F.current_timestamp()).alias("seen_us"))
        control.append_refused(refused, control_path, f"{cfg.feed}-{number}")
        if result.mark is not None:
            at_mark = kept.filter((F.col("reason") == envelope.OK) & (F.col("ts_ms") == result.mark))
            control.append_seen(at_mark.select(own, F.col("ts_ms").alias("last_upd"), "digest"), control_path)
            control.append(spark.createDataFrame([(cfg.feed, result.mark)], watermark.CONTROL_SCHEMA), control_path)
        control.append_fetch(spark, control_path, cfg.feed, number)
    finally:
        for stored in (known, repeated, since):
            stored.unpersist()
    return result


def _known(spark: SparkSession, cfg: FeedConfig, control_path: str, since: DataFrame, mark: int) -> DataFrame:
    """Digests of this fetch that an earlier one has taken; what is remembered is scanned, not moved."""
    own = F.col("feed_name") == cfg.feed
    taken = control.read_seen(spark, control_path).filter(own & (F.col("last_upd") == mark)).select("digest")
    refused = control.read_refused(spark, control_path).filter(own).select("digest")
    again = since.filter((F.col("reason") != envelope.OK) | (F.col("ts_ms") == mark)).select("digest")
    return taken.unionByName(refused).join(again, "digest", "left_semi").distinct()


def deliver(
    cfg: FeedConfig,
    classified: DataFrame,
    dead: Letters,
    publish: Callable[[DataFrame], DataFrame | None],
    batch: str | None = None,
    publish_dead: Callable[[DataFrame], None] | None = None,
    report: DeliveryLog | None = None,
) -> IntakeResult:
    """Publishes the good lines of classified ones and dead-letters the others.

    If publishing fails, the good lines of this batch go to the dead letters too, marked
    for retry; nothing is lost. With ``publish_dead`` the faulty lines also go to the
    dead-letter topic. A batch that is run again under its name replaces what its first try put, refused and
    undelivered lines each for themselves: those that go out the second time are undelivered no more.

    ``report`` gets the delivery report of the batch: messages per partition with the offsets that ``publish`` returns the
    stored messages with, or with the error that kept them back.
    """
    name = batch or uuid.uuid4().hex
    checked = classified.select(*CHECKED)
    # lines that the caller has stored in this form stay stored, and are not stored twice
    own = checked.storageLevel == StorageLevel.NONE
    if own:
        checked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good = envelope.valid(checked)
        delivered, error, stored = True, None, None
        try:
            stored = publish(encode_lines(good, cfg))
        except Exception as e:  # noqa: BLE001 - whatever the sink raises, the batch is kept
            delivered, error = False, f"{type(e).__name__}: {e}"
            log.warning("batch %s of %s is not delivered and kept for a replay", name, cfg.feed, exc_info=True)
        if report is not None:
            report.put(encode_lines(good, cfg) if stored is None else stored, name, error)
        key = deadletter.message_key("line")
        refused = deadletter.puts(envelope.quarantined(checked), "line", key, "reason")
        if publish_dead is not None:
            publish_dead(encode_letters(refused, cfg))
        dead.put(refused, f"{name}-refused")
        lost = good if not delivered else good.limit(0)
        dead.put(deadletter.puts(lost, "line", key, F.lit(envelope.UNDELIVERED)), f"{name}-undelivered")
        counts = {r["metric"]: r["n"] for r in audit.intake_counts(checked).collect()}  # four rows
        mark = good.agg(F.max("ts_ms").alias("t")).first()["t"]
    finally:
        if own:
            checked.unpersist()
    return IntakeResult(**counts, mark=mark, delivered=delivered, error=error)
