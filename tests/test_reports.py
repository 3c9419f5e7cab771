"""Delivery reports and landing accounts: a batch counts once, however often it is run, also after a compaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.config import FeedConfig
from tidemark.operators import envelope
from tidemark.plans import deadletters, intake, landing
from tidemark.plans.deadletters import Letters
from tidemark.plans.reports import Accounts, DeliveryLog
from tidemark.sources import rawzone, topic
from tidemark.streaming import jobs
from test_deadletter import down
from test_envelope import FLAT

CFG = FeedConfig(feed="f", row_schema=FLAT, topic="t", topic_partitions=2)


def line(key, ts):
    return f'{{"key":{{"id":"{key}"}},"value":{{"op":"u","ts_ms":{ts},"after":{{"id":"{key}","v":1.5}}}}}}'


def classified(spark, lines):
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    return envelope.classify(rows, CFG.keys, CFG.row_schema, with_value=True)


def counts(rows):
    return {r["status"]: r["n"] for r in rows.groupBy("status").agg(F.sum("n").alias("n")).collect()}


def test_a_report_says_where_messages_went(spark, folder):
    log, dead = DeliveryLog(spark, f"{folder}/log"), Letters(spark, f"{folder}/dead")
    lines = [line(k, 1) for k in range(20)] + ["{broken"]
    result = intake.deliver(CFG, classified(spark, lines), dead, lambda m: topic.publish(m, CFG, f"{folder}/t"), "f-intake-0", report=log)
    assert result.delivered and counts(log.report()) == {"delivered": 20}
    held = spark.read.parquet(f"{folder}/t").groupBy("partition").agg(F.count("*").alias("n"), F.max("offset").alias("m"))
    assert {(r["partition"], r["n"], r["max_offset"]) for r in log.report().collect()} == {tuple(r) for r in held.collect()}
    assert {r["topic"] for r in log.read().collect()} == {"t"}


def test_a_failed_batch_tells_its_error_until_it_goes_out(spark, folder):
    log, dead = DeliveryLog(spark, f"{folder}/log"), Letters(spark, f"{folder}/dead")
    rows = classified(spark, [line(k, 1) for k in range(6)])
    intake.deliver(CFG, rows, dead, down, "f-intake-0", report=log)
    failed = log.read().collect()
    assert {(r["status"], r["max_offset"]) for r in failed} == {("failed", None)} and sum(r["n"] for r in failed) == 6
    assert all("Error: " in r["error"] for r in failed)
    deadletters.replay(dead, CFG, down, report=log)
    deadletters.replay(dead, CFG, lambda m: None, report=log)
    # a sink that tells no offsets
    assert counts(log.report()) == {"failed": 12, "delivered": 6}
    assert {r["max_offset"] for r in log.report().filter("status = 'delivered'").collect()} == {None}
    intake.deliver(CFG, rows, dead, lambda m: None, "f-intake-0", report=log)
    assert counts(log.report()) == {"failed": 6, "delivered": 12}


def test_an_empty_log_and_an_empty_batch(spark, folder):
    log = DeliveryLog(spark, f"{folder}/log")
    assert log.report().count() == 0
    log.compact()
    intake.deliver(CFG, classified(spark, [line(1, 1)]).limit(0), Letters(spark, f"{folder}/dead"), lambda m: None, "f-intake-0", report=log)
    assert log.report().count() == 0
    assert Accounts(spark, f"{folder}/none").report().count() == 0


def test_the_newest_batch_of_a_job_is_not_folded(spark, folder):
    log = DeliveryLog(spark, f"{folder}/log")
    messages = spark.createDataFrame([("k", "t", 0, 7)], "key string, topic string, partition int, offset bigint")
    for name in ("f-intake-2", "f-intake-10", "f-intake-9", "g-intake-0", "f-replay-0a1b"):
        log.put(messages, name)
    for _ in range(2):
        log.compact()
        assert {r["name"] for r in log.read().collect()} == {"f-intake-10", "g-intake-0", "folded"}
        # the batches that may be run again
        for name in ("f-intake-10", "g-intake-0"):
            log.put(messages, name)
        assert [(r["n"], r["max_offset"]) for r in log.report().collect()] == [(5, 7)]


def messages_of(spark, rows):
    schema = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp, error string"
    df = spark.createDataFrame([(*r[:2], "t", *r[2:4], None, r[4]) for r in rows], schema)
    return df.withColumns({"key": F.encode("key", "UTF-8"), "value": F.encode("value", "UTF-8"), "timestamp": F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset"))})


def land(spark, folder, **kw):
    stream = topic.subscribe(spark, CFG, f"{folder}/topic", errors="error")
    dead, accounts = Letters(spark, f"{folder}/dead"), Accounts(spark, f"{folder}/accounts")
    jobs.start_landing(stream, CFG, f"{folder}/raw", dead, f"{folder}/c", drain=True, errors="error", accounts=accounts, **kw).awaitTermination()
    return dead, accounts


def good(key, ts):
    return f'{{"id":"{key}"}}', f'{{"op":"u","ts_ms":{ts},"after":{{"id":"{key}","v":1.5}}}}'


ROWS = [
    (*good(1, 1), 0, 0, None), (None, None, 0, 1, "_MSG_TIMED_OUT"), (None, None, 0, 2, "_MSG_TIMED_OUT"), ("{", "{", 0, 3, None),
    (None, None, 0, 4, "_PARTITION_EOF"), (*good(2, 2), 1, 0, None), (None, None, 1, 1, None), (None, None, 2, 0, "_PARTITION_EOF"),
]


def test_errors_are_letters_and_the_messages_around_them_land(spark, folder):
    messages_of(spark, ROWS).coalesce(1).write.parquet(f"{folder}/topic")
    dead, accounts = land(spark, folder)
    report = {r["partition"]: tuple(r)[1:] for r in accounts.report().collect()}
    # read, landed, refused, blank, eof, failed, max_offset: the end of a partition is no place in it
    assert report == {0: (5, 1, 1, 0, 1, 2, 3), 1: (2, 1, 0, 1, 0, 0, 1), 2: (1, 0, 0, 0, 1, 0, None)}
    assert rawzone.read(spark, f"{folder}/raw", landing.raw_schema(spark, CFG)).count() == 2
    letters = {(r["reason"], r["raw"]) for r in dead.read().collect()}
    errors = {raw for reason, raw in letters if reason == envelope.MESSAGE_ERROR}
    assert errors == {f'{{"error":"_MSG_TIMED_OUT","msg_partition":0,"msg_offset":{n}}}' for n in (1, 2)} and len(letters) == 3
    # nothing goes out again that never was an event
    deadletters.replay(dead, CFG, down)
    assert dead.read().filter("attempts > 0").count() == 0


def test_errors_of_different_places_are_not_copies(spark, folder):
    messages_of(spark, ROWS + ROWS[:2]).coalesce(1).write.parquet(f"{folder}/topic")
    dead, _ = land(spark, folder, once_within="1 day")
    assert dead.read().filter(F.col("reason") == envelope.MESSAGE_ERROR).count() == 2
    assert rawzone.read(spark, f"{folder}/raw", landing.raw_schema(spark, CFG)).count() == 2
