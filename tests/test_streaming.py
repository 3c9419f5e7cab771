"""Streams must end where the batch over the same events ends, also after a failure."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.config import FeedConfig
from tidemark.operators import changes
from tidemark.plans import landing, merging
from tidemark.plans.deadletters import Letters
from tidemark.sources import feed, rawzone, topic
from tidemark.streaming import jobs, progress
from test_deadletter import down
from test_envelope import FLAT

CFG = FeedConfig(feed="f", row_schema=FLAT, topic="t")


def history(n=120, seed=11):
    """Feed lines of twelve keys in a random order, one fault in ten, and what they end in."""
    rnd = random.Random(seed)
    lines, state = [], {}
    for ts in range(1, n + 1):
        key, op, v = str(rnd.randrange(12)), rnd.choice("iud"), ts / 4
        side = "before" if op == "d" else "after"
        if ts % 10 == 0:
            lines.append("{broken %d" % ts)
            continue
        lines.append(f'{{"key":{{"id":"{key}"}},"value":{{"op":"{op}","ts_ms":{ts},"{side}":{{"id":"{key}","v":{v}}}}}}}')
        state.pop(key, None)
        if op != "d":
            state[key] = v
    rnd.shuffle(lines)
    return lines, state


def feed_files(spark, folder, lines, files=6):
    for i in range(files):
        rows = spark.createDataFrame([(x,) for x in lines[i::files]], "value string")
        rows.coalesce(1).write.mode("append").text(f"{folder}/feed")


def pipeline(spark, folder, publish=None):
    """Feed -> topic -> raw zone -> target, every step drained once."""
    dead = Letters(spark, f"{folder}/dead")
    publish = publish or (lambda m, n: topic.publish(m, CFG, f"{folder}/topic", str(n)))
    source = feed.stream_lines(spark, f"{folder}/feed", max_files=2)
    jobs.start_intake(source, CFG, dead, publish, f"{folder}/c1", drain=True).awaitTermination()
    sent = topic.subscribe(spark, CFG, f"{folder}/topic", max_files=2)
    jobs.start_landing(sent, CFG, f"{folder}/raw", dead, f"{folder}/c2", drain=True).awaitTermination()
    schema = landing.raw_schema(spark, CFG)
    target = merging.Target(spark, f"{folder}/target", schema, CFG.keys, CFG.order)
    raw = rawzone.stream(spark, f"{folder}/raw", schema, max_files=2).drop(rawzone.DAY)
    jobs.start_merge(raw, CFG, target, f"{folder}/c3", drain=True).awaitTermination()
    return dead, target


def live_values(target):
    return {r["id"]: r["v"] for r in target.rows().collect()}


def test_whole_chain_equals_the_model(spark, folder):
    lines, state = history()
    feed_files(spark, folder, lines)
    dead, table = pipeline(spark, folder)
    assert live_values(table) == state
    assert {r["raw"] for r in dead.read().collect()} == {x for x in lines if x.startswith("{broken")}
    raw = rawzone.read(spark, f"{folder}/raw", landing.raw_schema(spark, CFG))
    assert raw.count() == 108 and raw.select("ts_ms").distinct().count() == 108
    # nothing new: a second run changes nothing
    before = table.changes().count()
    pipeline(spark, folder)
    assert table.changes().count() == before and live_values(table) == state
    merging.compact(table, "2024-01-01")
    assert table.changes().count() == 0 and live_values(table) == state


def test_intake_failover_keeps_every_line(spark, folder):
    lines, _ = history(40)
    feed_files(spark, folder, lines, files=3)
    dead = Letters(spark, f"{folder}/dead")
    source = feed.stream_lines(spark, f"{folder}/feed")
    jobs.start_intake(source, CFG, dead, lambda m, n: down(m), f"{folder}/c1", drain=True).awaitTermination()
    assert {r["raw"] for r in dead.read().collect()} == set(lines)


@pytest.mark.parametrize("when", ["before", "after"])
def test_landing_restarts_after_a_failure(spark, folder, monkeypatch, when):
    """A batch dies before or after its raw rows are written; the restart leaves them once."""
    lines, state = history()
    feed_files(spark, folder, lines)
    dead = Letters(spark, f"{folder}/dead")
    source = feed.stream_lines(spark, f"{folder}/feed", max_files=2)
    publish = lambda m, n: topic.publish(m, CFG, f"{folder}/topic", str(n))
    jobs.start_intake(source, CFG, dead, publish, f"{folder}/c1", drain=True).awaitTermination()

    write, failures = rawzone.write, [ConnectionError("executor lost")]

    def dying(rows, path, fmt, batch, **kw):
        if when == "after":
            write(rows, path, fmt, batch, **kw)
        if batch.endswith("-1") and failures:
            raise failures.pop()
        if when == "before":
            write(rows, path, fmt, batch, **kw)

    monkeypatch.setattr(rawzone, "write", dying)

    def attempt():
        sent = topic.subscribe(spark, CFG, f"{folder}/topic", max_files=1)
        jobs.start_landing(sent, CFG, f"{folder}/raw", dead, f"{folder}/c2", drain=True).awaitTermination()

    with pytest.raises(Exception, match="executor lost"):
        attempt()
    attempt()
    raw = rawzone.read(spark, f"{folder}/raw", landing.raw_schema(spark, CFG))
    assert sorted(r["ts_ms"] for r in raw.collect()) == [t for t in range(1, 121) if t % 10]
    net = changes.latest(raw, CFG.keys, CFG.order).filter("op <> 'D'")
    assert {r["id"]: r["v"] for r in net.collect()} == state


def test_duplicates_in_a_stream(spark, folder):
    # not at the epoch itself: there the stream's first watermark would call every row late
    rows = [(k, t, s) for k in "ab" for t in range(5) for s in range(2)]
    df = spark.createDataFrame(rows * 3, "id string, t int, seq int").withColumn("at", F.timestamp_seconds(F.col("t") + 1_700_000_000))
    df.repartition(6).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    once = changes.dedupe_stream(stream, ["id", "at", "seq"], "at", "1 hour")
    jobs.start(once, lambda b, n: progress.write_batch(b, n, f"{folder}/out"), CFG, f"{folder}/c", drain=True).awaitTermination()
    out = spark.read.schema(df.schema).parquet(f"{folder}/out")
    assert sorted((r["id"], r["t"], r["seq"]) for r in out.collect()) == sorted(rows)


def test_progress(spark, folder):
    df = spark.range(10).selectExpr("cast(id % 2 as int) as partition", "id as offset")
    df.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    q = jobs.start(stream, lambda b, n: progress.write_batch(b, n, f"{folder}/out"), CFG, f"{folder}/c", drain=True)
    q.awaitTermination()
    assert sum(n for _, n in progress.progress_rows(q)) == 10
    got = {r["partition"]: (r["n"], r["max_offset"]) for r in progress.committed(spark.read.schema(df.schema).parquet(f"{folder}/out")).collect()}
    assert got == {0: (5, 8), 1: (5, 9)}


def test_a_micro_batch_of_few_files_is_dealt_over_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = (spark.range(0, 1000, numPartitions=n) for n in (1, 2 * cores))
    dealt = jobs.over_cores(few)
    assert dealt.rdd.getNumPartitions() == cores and sorted(r["id"] for r in dealt.collect()) == list(range(1000))
    assert jobs.over_cores(many).rdd.getNumPartitions() == 2 * cores
