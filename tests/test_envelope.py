from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import SAMPLE_ROW_SCHEMA
from tidemark.operators import audit, envelope
from tidemark.sources import feed

FLAT = T.StructType().add("id", "string").add("v", "double")


def event(op="u", key='{"id":"1"}', image='{"id":"1","v":1.5}', side=None, time='"ts_ms":5,'):
    side = side or ("before" if op in ("d", "D") else "after")
    return f'{{"key":{key},"value":{{"op":"{op}",{time}"{side}":{image}}}}}'


CASES = [
    (event(), "ok"),
    (event(op="U"), "ok"),
    (event(op=" I "), "ok"),
    (event(op="d"), "ok"),
    (event(image='{"v":2,"id":"1","more":[1]}'), "ok"),
    ("  " + event() + " ", "ok"),
    ("", "blank"),
    ("  \t ", "blank"),
    (None, "blank"),
    (event()[:20], "malformed_json"),
    (event() + " x", "malformed_json"),
    (event() + "," + event(), "malformed_json"),
    (event() + "]", "malformed_json"),
    (event() + "] x", "malformed_json"),
    ('{"key":1,"key":2,"value":{}}', "malformed_json"),
    ("key value", "malformed_json"),
    ('{"monkey":1,"values":2}', "missing_envelope"),
    ('{"key":{"id":"1"}}', "missing_envelope"),
    ('{"value":{"op":"u"}}', "missing_envelope"),
    ('["key","value"]', "missing_envelope"),
    ('"key value"', "missing_envelope"),
    (event(key="null"), "null_key"),
    (event(key='{"id":null}'), "null_key"),
    (event(key='{"uid":"1"}'), "key_mismatch"),
    (event(key='{"id":"1","b":2}'), "key_mismatch"),
    (event(key='"1"'), "key_mismatch"),
    (event(op="x"), "unknown_op"),
    ('{"key":{"id":"1"},"value":5}', "unknown_op"),
    (event(op="d", side="after"), "null_image"),
    (event(op="u", side="before"), "null_image"),
    (event(image="null"), "null_image"),
    (event(time=""), "null_order"),
    (event(time='"ts_ms":"soon",'), "null_order"),
    (event(time='"ts_ms":9223372036854775807,'), "null_order"),
    (event(image='{"id":7,"v":1.5}'), "schema_violation"),
    (event(image='{"id":"1"}'), "schema_violation"),
    (event(image='{"id":"1","v":null}'), "schema_violation"),
    (event(image='{"id":"1","v":"text"}'), "schema_violation"),
    (event(image='{"id":"1","v":{"a":1}}'), "schema_violation"),
    (event(image="[1]"), "schema_violation"),
    (event(key='{"id":"2"}'), "key_mismatch"),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(CASES)], "n int, line string")
    rows = envelope.classify(df, ["id"], FLAT).collect()
    assert len(rows) == len(CASES)
    got = {r["n"]: r["reason"] for r in rows}
    assert {CASES[n][0]: r for n, r in got.items()} == {line: want for line, want in CASES}


def test_envelope_level_reasons_agree_with_full_ones(spark):
    df = spark.createDataFrame([(line,) for line, _ in CASES], "line string")
    outer = {"blank", "bad_utf8", "malformed_json", "missing_envelope"}
    for r in envelope.classify_envelope(df).collect():
        want = dict(CASES)[r["line"]]
        assert r["reason"] == (want if want in outer else "ok")


def test_bytes(spark):
    raw = [(b"\xff\xfe", "bad_utf8"), (event().encode(), "ok"), (b"", "blank"), ("{\"kéy\":1}".encode(), "missing_envelope")]
    df = spark.createDataFrame([(b,) for b, _ in raw], "value binary")
    got = {bytes(r["value"]): r["reason"] for r in envelope.classify(df, ["id"], FLAT, "value", binary=True).collect()}
    assert got == dict(raw)


def test_image_and_times(spark):
    lines = [
        (event(op="d", time='"ts_ms":1465581029523,"ts_us":1465581029523758,"ts_ns":1465581029523758914,'),),
        (event(op="u", time='"ts_ms":7,'),),
    ]
    rows = envelope.image_rows(envelope.classify(spark.createDataFrame(lines, "line string"), ["id"], FLAT), FLAT).collect()
    by_op = {r["op"]: r for r in rows}
    assert by_op["D"]["ts_ns"] == 1465581029523758914 and by_op["D"]["id"] == "1" and by_op["D"]["v"] == 1.5
    assert (by_op["U"]["ts_ms"], by_op["U"]["ts_us"], by_op["U"]["ts_ns"]) == (7, 7000, 7000000)


def test_composite_keys(spark):
    schema = T.StructType().add("a", "string").add("b", "long")
    lines = [
        '{"key":{"b":2,"a":"x"},"value":{"op":"i","ts_ms":1,"after":{"a":"x","b":2}}}',
        '{"key":{"a":"x"},"value":{"op":"i","ts_ms":1,"after":{"a":"x","b":2}}}',
        '{"key":{"a":"x","b":null},"value":{"op":"i","ts_ms":1,"after":{"a":"x","b":2}}}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    rows = envelope.classify(df, ["a", "b"], schema).collect()
    assert [r["reason"] for r in rows] == ["ok", "key_mismatch", "null_key"]
    assert json.loads(rows[0]["key_text"]) == {"a": "x", "b": 2}
    names = {r["key_cols"]: r["n"] for r in envelope.key_columns(envelope.classify(df, ["a", "b"], schema)).collect()}
    assert names == {"a,b": 2, "a": 1}


def test_a_filter_on_the_reason_does_not_parse_twice(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", F.col("props").alias("line"))
    picked = envelope.valid(envelope.classify(df, ["id"], FLAT)).filter("event_id > 5")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,5)]" in plan


def test_message_errors(spark):
    df = spark.createDataFrame(
        [(0, None), (0, "_PARTITION_EOF"), (0, "_TIMED_OUT"), (1, None)], "partition int, error string"
    )
    marked = envelope.with_errors(df.withColumn("reason", F.lit(envelope.OK)))
    assert envelope.valid(marked).count() == 2 and [r["error"] for r in envelope.quarantined(marked).collect()] == ["_TIMED_OUT"]
    got = {r["partition"]: (r["good"], r["eof"], r["error"]) for r in envelope.error_counts(df).collect()}
    assert got == {0: (1, 1, 1), 1: (1, 0, 0)}


def test_counts_add_up(spark):
    df = spark.createDataFrame([(line,) for line, _ in CASES], "line string")
    n = {r["metric"]: r["n"] for r in audit.intake_counts(envelope.classify(df, ["id"], FLAT)).collect()}
    assert n["read"] == len(CASES) == n["published"] + n["quarantined"] + n["blank"]
    assert n["published"] == sum(r == "ok" for _, r in CASES)


# a bicycle in the shape of the registered row
BICYCLE = {
    "id": "0042",
    "type": "bicycle",
    "name": "Harbour",
    "ppu": 731.25,
    "batters": {"batter": [{"id": "w-26", "type": "Front wheel"}, {"id": "w-28", "type": "Rear wheel, rider's side"}]},
    "topping": [{"id": "bell", "type": "Brass"}, {"id": "rack", "type": "Steel"}],
}


def test_pretty_printed_documents(spark, folder):
    """Indented JSON over many lines, several documents in one file as an array."""
    spark.createDataFrame([(json.dumps([BICYCLE, {**BICYCLE, "id": "0043", "name": 'a "b"\n'}], indent=2),)], "value string") \
        .coalesce(1).write.text(folder)
    rows = feed.read_documents(spark, folder, SAMPLE_ROW_SCHEMA).orderBy("id").collect()
    assert [r["id"] for r in rows] == ["0042", "0043"]
    assert rows[1]["name"] == 'a "b"\n' and rows[0]["batters"]["batter"][1]["type"] == "Rear wheel, rider's side"


MESSAGES = [
    ('{"id":"1"}', '{"op":"u","ts_ms":5,"before":null,"after":{"id":"1","v":1.5}}', "ok"),
    (' {"id":"1"} ', ' {"op":"d","ts_ms":5,"before":{"id":"1","v":2},"after":null} ', "ok"),
    (None, '{"op":"u","ts_ms":5,"after":{"id":"1","v":1.5}}', "missing_envelope"),
    ("", '{"op":"u","ts_ms":5,"after":{"id":"1","v":1.5}}', "missing_envelope"),
    ('{"id":"1"}', None, "missing_envelope"),
    ('{"id":"1"}', "5", "missing_envelope"),
    (None, None, "blank"),
    (" ", "\t", "blank"),
    ('{"id":"1"}', '{"op":"u"', "malformed_json"),
    ('{"id":"1"}', '{"op":"u"},{"a":1}', "malformed_json"),
    ('[{"id":"1"}', '{"op":"u"}]', "malformed_json"),
    ('{"id":"1"}', '{"op":"u","op":"u"}', "malformed_json"),
    (b"\xff", '{"op":"u"}', "bad_utf8"),
    ('{"id":"1"}', b"\xff\xfe", "bad_utf8"),
    ("null", '{"op":"u","ts_ms":5,"after":{"id":"1","v":1.5}}', "null_key"),
    ('{"id":"2"}', '{"op":"u","ts_ms":5,"after":{"id":"1","v":1.5}}', "key_mismatch"),
    ('{"uid":"1"}', '{"op":"u","ts_ms":5,"after":{"id":"1","v":1.5}}', "key_mismatch"),
    ('{"id":"1"}', '{"op":"x","ts_ms":5,"after":{"id":"1","v":1.5}}', "unknown_op"),
    ('{"id":"1"}', '{"op":"u","ts_ms":5,"after":{"id":"1"}}', "schema_violation"),
]


def test_messages(spark):
    raw = lambda x: x.encode() if isinstance(x, str) else x
    df = spark.createDataFrame([(n, raw(k), raw(v)) for n, (k, v, _) in enumerate(MESSAGES)], "n int, key binary, value binary")
    got = {r["n"]: r["reason"] for r in envelope.classify_messages(df, ["id"], FLAT).collect()}
    assert [got[n] for n in range(len(MESSAGES))] == [want for *_, want in MESSAGES]


def test_value_text_is_the_value_part(spark):
    df = spark.createDataFrame([(event(),), ("{",)], "line string")
    rows = envelope.classify(df, ["id"], FLAT, with_value=True).collect()
    assert json.loads(rows[0]["value_text"]) == json.loads(event())["value"] and rows[1]["value_text"] is None


def test_row_names_that_need_quotes(spark):
    schema = T.StructType().add("the id", "string").add("a.b", T.StructType().add("x-y", "long")).add("l", T.ArrayType(T.StructType().add("`", "string")))
    image = {"the id": "1", "a.b": {"x-y": 3}, "l": [{"`": "t"}]}
    line = json.dumps({"key": {"the id": "1"}, "value": {"op": "i", "ts_ms": 1, "after": image}})
    df = spark.createDataFrame([(line,)], "line string")
    row = envelope.image_rows(envelope.classify(df, ["the id"], schema), schema).first()
    assert row["the id"] == "1" and row["a.b"]["x-y"] == 3 and row["l"][0]["`"] == "t"


@pytest.mark.parametrize("mark,want", [(0, {"a", "b", "c", "bad"}), (6, {"b", "c", "bad"}), (100, {"bad"})])
def test_lines_since_keeps_what_it_cannot_read(spark, mark, want):
    lines = {"a": event(time='"ts_ms":5,'), "b": event(time='"ts_ms":6,'), "c": event(time='"ts_ms":99,'), "bad": "{"}
    df = spark.createDataFrame(list(lines.items()), "n string, line string")
    assert {r["n"] for r in feed.classified_since(envelope.classify(df, ["id"], FLAT), mark).collect()} == want


def test_earlier_lines_are_left_out_before_the_checks(spark):
    """The mark's own instant and lines without a readable time stay, and the filter stands below the contract's tests."""
    texts = [event(time=f'"ts_ms":{t},') for t in (4, 5, 6)] + [event(time=""), event(time='"ts_ms":"x",'), "{broken", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "line string")
    late = envelope.classify(rows, ["id"], FLAT, since_ms=5)
    assert [r.line for r in late.collect()] == texts[1:]
    whole = envelope.classify(rows, ["id"], FLAT).filter("coalesce(ts_ms, 5) >= 5")
    columns = [c for c in whole.columns if c != "image"]
    assert late.select(*columns).collect() == whole.select(*columns).collect()
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert plan.index("schema_of_variant" if "schema_of_variant" in plan else "schemaOfVariant") < plan.index("Filter (coalesce(") and plan.count("parseJson") == 1
