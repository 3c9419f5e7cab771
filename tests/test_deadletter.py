from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tidemark.config import FeedConfig
from tidemark.operators import contract, deadletter, envelope, watermark
from tidemark.plans import deadletters, intake
from tidemark.plans.deadletters import Letters
from tidemark.sources import control, topic
from test_envelope import CASES, FLAT, event

CFG = FeedConfig(feed="f", row_schema=FLAT)


def at(second):
    return datetime.datetime(2024, 1, 1, 0, 0, second)


def put_log(spark, *rows):
    return spark.createDataFrame([(k, raw, reason, 0, 1, at(s), at(s)) for k, raw, reason, s in rows], deadletter.LOG_SCHEMA)


def by_key(df):
    return {r["dlq_key"]: r for r in df.collect()}


def test_last_put_wins_and_puts_add_up(spark):
    log = put_log(spark, ("k", "r1", "undelivered", 1), ("k", "r2", "malformed_json", 3), ("k", "r3", "undelivered", 2), ("j", "x", "undelivered", 1))
    got = by_key(deadletter.state(log))
    assert (got["k"]["raw"], got["k"]["reason"], got["k"]["puts"], got["k"]["attempts"], got["k"]["retriable"]) == ("r2", "malformed_json", 3, 0, False)
    assert (got["k"]["first_seen"], got["k"]["last_seen"]) == (at(1), at(3))
    assert got["j"]["retriable"]


def test_puts_never_make_an_item_stale(spark):
    log = put_log(spark, *[("k", "r", "undelivered", s % 60) for s in range(500)])
    row = deadletter.state(log).first()
    assert row["retriable"] and row["puts"] == 500 and row["attempts"] == 0


def test_combining_in_steps_equals_combining_at_once(spark):
    log = put_log(spark, *[("k", f"r{s}", "undelivered", s) for s in range(3)], ("j", "x", "malformed_json", 9))
    parts = [log.filter(F.col("raw") == r) for r in ("r2", "x", "r0", "r1")]
    stepwise = deadletter.combined(parts[0])
    for part in parts[1:]:
        stepwise = deadletter.combined(stepwise.unionByName(deadletter.combined(part)))
    assert by_key(deadletter.state(stepwise)) == by_key(deadletter.state(log))


def test_split_alerts_purge(spark):
    log = put_log(spark, ("a", "1", "undelivered", 5), ("b", "2", "malformed_json", 6), ("c", "3", "malformed_json", 4))
    state = deadletter.state(log)
    assert set(by_key(deadletter.retriable(state))) == {"a"} and set(by_key(deadletter.stale(state))) == {"b", "c"}
    alert = deadletter.alerts(state).collect()
    assert [(r["reason"], r["n"], r["oldest"]) for r in alert] == [("malformed_json", 2, at(4))]
    after = deadletter.state(log.unionByName(deadletter.purges(state, F.lit(at(50)))))
    assert set(by_key(after)) == {"a"}
    # a line that comes again after its purge is an item again
    again = log.unionByName(deadletter.purges(state, F.lit(at(50)))).unionByName(put_log(spark, ("b", "2", "malformed_json", 55)))
    assert set(by_key(deadletter.state(again))) == {"a", "b"}


def test_outcomes(spark):
    log = put_log(spark, *[(k, k, "undelivered", 1) for k in "abc"], ("d", "4", "malformed_json", 1))
    tried = deadletter.retriable(deadletter.state(log)).drop("reason")
    reason = F.when(F.col("dlq_key") == "b", "undelivered").when(F.col("dlq_key") == "c", "schema_violation")
    for now in (at(2), at(1)):  # also in the very second of the put
        out = deadletter.outcomes(tried.withColumn("_reason", reason), F.lit(now))
        got = by_key(deadletter.state(log.unionByName(out)))
        assert set(got) == {"b", "c", "d"}
        assert (got["b"]["attempts"], got["b"]["retriable"], got["b"]["raw"]) == (1, True, "b")
        assert (got["c"]["attempts"], got["c"]["reason"], got["c"]["retriable"]) == (1, "schema_violation", False)
        assert got["d"]["attempts"] == 0


def test_many_replays_raise_an_alert_and_nothing_else(spark):
    state = deadletter.state(put_log(spark, ("a", "1", "undelivered", 1))).withColumn("attempts", F.lit(7))
    assert deadletter.alerts(state).count() == 0
    assert [(r["reason"], r["n"]) for r in deadletter.alerts(state, 5).collect()] == [("undelivered", 1)]
    assert deadletter.purges(state).count() == 0


def test_keys(spark):
    df = spark.createDataFrame([("x", '{"id":"1"}'), ("x", None)], "raw string, key_text string")
    got = df.select(deadletter.record_key("raw", "key_text").alias("r"), deadletter.message_key("raw").alias("m")).collect()
    digest = "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
    assert [r["r"] for r in got] == ['{"id":"1"}', digest] and {r["m"] for r in got} == {digest}


def down(messages):
    raise ConnectionError("topic is not available")


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def classified(spark, *texts, cfg=CFG):
    return envelope.classify(lines(spark, *texts), cfg.keys, cfg.row_schema, with_value=True)


def sent_in(spark, folder):
    return spark.read.schema(topic.MESSAGE_SCHEMA).parquet(folder).collect()


def values_in(spark, folder):
    return sorted(bytes(r["value"]).decode() for r in sent_in(spark, folder))


def test_intake_publishes_quarantines_and_moves_the_mark(spark, folder):
    dead = Letters(spark, f"{folder}/dead")
    publish = lambda m: topic.publish(m, CFG, f"{folder}/topic")
    texts = [text for text, _ in CASES if text is not None]
    result = intake.run(spark, CFG, lines(spark, *texts), f"{folder}/control", dead, publish)
    ok = len({text for text, reason in CASES if reason == "ok"})
    assert result.delivered and result.mark == 5 and result.published == ok
    assert result.read == result.published + result.quarantined + result.blank
    sent = sent_in(spark, f"{folder}/topic")
    assert len(sent) == ok and {bytes(r["key"]) for r in sent} == {b'{"id":"1"}'}
    assert all(set(json.loads(bytes(r["value"]))) <= {"op", "ts_ms", "before", "after"} for r in sent), "the value part"
    assert len({r["partition"] for r in sent}) == 1, "one key, one partition"
    assert {r["reason"] for r in dead.read().collect()} == {reason for _, reason in CASES} - {"ok", "blank"}
    # an empty fetch: the mark stays
    assert intake.run(spark, CFG, lines(spark, ""), f"{folder}/control", dead, publish).mark is None
    assert watermark.mark_of(control.read(spark, f"{folder}/control"), "f") == 5
    # the mark's instant once more, with one line more: only that one goes out
    more = event(image='{"id":"1","v":99}')
    assert intake.run(spark, CFG, lines(spark, *texts, more, more), f"{folder}/control", dead, publish).published == 1
    assert len(sent_in(spark, f"{folder}/topic")) == ok + 1
    assert intake.run(spark, CFG, lines(spark, *texts, more), f"{folder}/control", dead, publish).published == 0


def test_feeds_fetched_at_once_keep_their_marks(spark, folder):
    dead, other = Letters(spark, f"{folder}/dead"), FeedConfig(feed="g", row_schema=FLAT)

    def meanwhile(messages):
        late = lines(spark, event(time='"ts_ms":99,'))
        intake.run(spark, other, late, f"{folder}/control", dead, lambda m: topic.publish(m, other, f"{folder}/g"))
        topic.publish(messages, CFG, f"{folder}/f")

    intake.run(spark, CFG, lines(spark, event(time='"ts_ms":7,')), f"{folder}/control", dead, meanwhile)
    marks = watermark.marks(control.read(spark, f"{folder}/control"))
    assert {(r["feed_name"], r["last_upd"]) for r in marks.collect()} == {("f", 7), ("g", 99)}


def test_an_outage_loses_and_doubles_nothing(spark, folder):
    dead = Letters(spark, f"{folder}/dead")
    good = [event(time=f'"ts_ms":{n},') for n in range(5)]
    for poll in range(6):
        assert not intake.deliver(CFG, classified(spark, *good, "{"), dead, down, f"poll-{poll}").delivered
    deadletters.purge(dead, f"{folder}/alerts")
    deadletters.replay(dead, CFG, down)
    assert {(r["reason"], r["attempts"], r["retriable"]) for r in dead.read().collect()} == {("undelivered", 1, True)}
    dead.compact()
    assert dead.read().count() == 5
    deadletters.replay(dead, CFG, lambda m: topic.publish(m, CFG, f"{folder}/topic"))
    deadletters.replay(dead, CFG, down)
    assert dead.read().count() == 0
    assert sorted(map(json.loads, values_in(spark, f"{folder}/topic")), key=lambda v: v["ts_ms"]) == sorted((json.loads(g)["value"] for g in good), key=lambda v: v["ts_ms"])
    dead.compact()
    assert dead.log().count() == 0
    assert [(r["reason"], r["n"]) for r in spark.read.parquet(f"{folder}/alerts").collect()] == [("malformed_json", 1)]


def test_a_repeated_batch_during_an_outage(spark, folder):
    """The first try died after its dead letters were put; the second finds the topic down, up, or dying half-way."""
    good = event()

    def half(messages):
        topic.publish(messages, CFG, f"{folder}/topic", "0")
        raise ConnectionError("lost inside the write")

    for n, second in enumerate((down, half)):
        dead = Letters(spark, f"{folder}/dead-{n}")
        intake.deliver(CFG, classified(spark, good, "{"), dead, down, "b-0")
        result = intake.deliver(CFG, classified(spark, good, "{"), dead, second, "b-0")
        assert not result.delivered and (result.read, result.published, result.quarantined) == (2, 1, 1)
        assert {(r["reason"], r["puts"]) for r in dead.read().collect()} == {("undelivered", 1), ("malformed_json", 1)}
    dead = Letters(spark, f"{folder}/dead-up")
    intake.deliver(CFG, classified(spark, good, "{"), dead, down, "b-0")
    assert intake.deliver(CFG, classified(spark, good, "{"), dead, lambda m: topic.publish(m, CFG, f"{folder}/up", "0"), "b-0").delivered
    assert [r["reason"] for r in dead.read().collect()] == ["malformed_json"] and len(sent_in(spark, f"{folder}/up")) == 1


def test_replay_checks_again(spark, folder):
    dead = Letters(spark, f"{folder}/dead")
    dead.put(deadletter.puts(lines(spark, event(), event(image='{"id":"1"}')), "line", deadletter.message_key("line"), F.lit("undelivered")))
    deadletters.replay(dead, CFG, lambda m: topic.publish(m, CFG, f"{folder}/topic"))
    assert [(r["reason"], r["retriable"]) for r in dead.read().collect()] == [("schema_violation", False)]
    assert len(sent_in(spark, f"{folder}/topic")) == 1


def test_faulty_lines_also_go_to_the_dead_letter_topic(spark, folder):
    cfg = FeedConfig(feed="f", row_schema=FLAT, dead_letter_topic="dlq")
    send = lambda name: lambda m: topic.publish(m, cfg, f"{folder}/{name}")
    dead = Letters(spark, f"{folder}/dead")
    for text in ("{", '{"monkey":1}'):
        intake.deliver(cfg, classified(spark, event(), text), dead, send("topic"), publish_dead=send("dlq"))
    got = {(r["topic"], json.loads(bytes(r["value"]))["raw"], json.loads(bytes(r["value"]))["reason"]) for r in sent_in(spark, f"{folder}/dlq")}
    assert got == {("dlq", "{", "malformed_json"), ("dlq", '{"monkey":1}', "missing_envelope")}
    assert len(sent_in(spark, f"{folder}/topic")) == 2, "both publishes stay"


def test_settings_take_the_registered_schema(spark):
    cfg = FeedConfig(feed="f", topic="t")
    history = [("t-value", 1, contract.avro_of_struct("Row", FLAT), False)]
    resolved = intake.resolve(cfg, spark.createDataFrame(history, contract.HISTORY_SCHEMA))
    assert resolved.row_schema == FLAT and resolved.topic == "t"


def test_kafka_options(spark):
    cfg = FeedConfig(feed="f", topic="t", bootstrap_servers="broker:9092", max_offsets=1000)
    read = cfg.read_options()
    assert read["subscribe"] == "t" and read["startingOffsets"] == "earliest" and read["maxOffsetsPerTrigger"] == "1000"
    write = cfg.write_options()
    assert write["kafka.bootstrap.servers"] == "broker:9092" and write["kafka.enable.idempotence"] == "true"
    assert write["kafka.max.in.flight.requests.per.connection"] == "1" and cfg.subject == "t-value"
    with pytest.raises(ValueError):
        FeedConfig(feed="f").read_options()
    # the connector is not on this class path; the functions do go to it
    with pytest.raises(Exception, match="(?i)kafka"):
        topic.subscribe(spark, cfg)


def test_a_delivery_leaves_lines_that_were_stored_before_it_stored(spark, folder):
    """Polls that bring the same lines share them as they were classified; a delivery stores only what is not."""
    lines = spark.createDataFrame([(event(),), ("{broken",)], "line string")
    classified = envelope.classify(lines, CFG.keys, CFG.row_schema, with_value=True).select(*intake.CHECKED).persist()
    letters = Letters(spark, f"{folder}/letters")
    for poll in ("a", "b"):
        intake.deliver(CFG, classified, letters, down, poll)
        assert classified.storageLevel.useMemory
    assert {(r.reason, r.puts) for r in letters.read().collect()} == {("undelivered", 2), ("malformed_json", 2)}
    classified.unpersist()
    intake.deliver(CFG, classified, letters, down, "c")
    assert not classified.storageLevel.useMemory
