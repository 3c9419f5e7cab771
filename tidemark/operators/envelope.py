"""Feed lines and topic messages: parse once, name the fault, route, pick the row image.

A line is parsed a single time into a variant; presence tests, type tests and the row image
are all read from it. Nothing is dropped: every input row leaves with a ``reason``,
``ok`` or the first fault that applies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import jsontext as J
from tidemark.operators import contract
from tidemark.operators.changes import DELETE, normal_op

OK, BLANK = "ok", "blank"
UNDELIVERED = "undelivered"
# what a consumer's error says about a message; such a message has no event
END, MESSAGE_ERROR = "end_of_partition", "message_error"
# Every reason a line can get, in the order the tests are made.
REASONS = (
    BLANK, "bad_utf8", "malformed_json", "missing_envelope", "null_key", "key_mismatch",
    "unknown_op", "null_image", "null_order", "unknown_schema", "schema_violation", OK,
)


def classify_envelope(lines: DataFrame, text: str = "line", binary: bool = False) -> DataFrame:
    """Envelope-level ``reason`` only: blank, bad bytes, no JSON, no ``key``/``value``, or ok."""
    has_both = J.line_has("_parsed", "key") & J.line_has("_parsed", "value")
    reason = F.coalesce(*_envelope_faults(has_both), F.lit(OK)).alias("reason")
    return _settled(_parsed(lines, text, binary).select(*lines.columns, reason), ["reason"])


def classify(
    lines: DataFrame,
    keys: Sequence[str],
    row_schema: T.StructType,
    text: str = "line",
    binary: bool = False,
    with_value: bool = False,
    versions: Mapping[int, T.StructType] | None = None,
    since_ms: int | None = None,
) -> DataFrame:
    """Full classification of feed lines against key columns and row contract.

    Keeps the input columns and adds ``reason``, ``violations`` and the parts of the
    event the next steps need: ``key_text``, ``op``, ``ts_ms``, ``ts_us``, ``ts_ns`` and
    ``image`` (variant of the row image the operation stands for); ``with_value`` also
    ``value_text``, the JSON of the event's value part.

    With ``versions`` an event is checked against the schema version that its value part names
    (``schema_version``), against ``row_schema`` if it names none; one that is not in force is ``unknown_schema``.

    With ``since_ms`` lines of an earlier event time are left out as soon as they are parsed, before any check; those
    without a readable time stay.
    """
    has_value = F.when(F.col("op").isNotNull(), F.lit(True)).otherwise(J.line_has("_parsed", "value"))
    has_both = F.col("_key").isNotNull() & has_value
    parsed = _parsed(lines, text, binary)
    if since_ms is not None:
        time = J.in_line("_parsed", "value", "ts_ms", as_type="bigint")
        timed = _settled(parsed.withColumn("_time", time), ["_parsed", "_time"])
        parsed = timed.filter(F.coalesce("_time", F.lit(since_ms)) >= since_ms).drop("_time")
    return _classified(parsed, lines.columns, keys, row_schema, '$[0]["key"]', '$[0]["value"]', has_both, 1, with_value, versions)


def classify_messages(
    messages: DataFrame,
    keys: Sequence[str],
    row_schema: T.StructType,
    key: str = "key",
    value: str = "value",
    versions: Mapping[int, T.StructType] | None = None,
) -> DataFrame:
    """The same for topic messages, whose key and value are JSON bytes of their own.

    A message without a key or without a value has no envelope.
    """
    k, v = J.decoded(key), J.decoded(value)
    utf8 = (F.col(key).isNull() | F.col("_k").isNotNull()) & (F.col(value).isNull() | F.col("_v").isNotNull())
    blank = lambda c: F.coalesce(J.is_blank(c), F.lit(True))
    raw = messages.withColumns({"_k": k, "_v": v})
    raw = raw.withColumns({"_utf8": utf8, "_bare": blank("_k") | blank("_v")})
    # blank where both are: such a message says nothing
    raw = raw.withColumn("_text", F.when(blank("_k") & blank("_v"), "").otherwise(F.lit("{}")))
    # a side that is missing is null, which has no envelope
    raw = raw.withColumns({"_k": F.when(blank("_k"), "null").otherwise(F.col("_k")), "_v": F.when(blank("_v"), "null").otherwise(F.col("_v"))})
    parsed = raw.withColumn("_parsed", J.bracketed("_k", "_v"))
    has_both = ~F.col("_bare") & (J.in_line("_parsed", as_type="struct<>", root="$[1]").isNotNull())
    return _classified(parsed, messages.columns, keys, row_schema, "$[0]", "$[1]", has_both, 2, versions=versions)


def _classified(
    parsed: DataFrame, columns: Sequence[str], keys: Sequence[str], row_schema: T.StructType, key_root: str, value_root: str,
    has_both: Column, texts: int, with_value: bool = False, versions: Mapping[int, T.StructType] | None = None,
) -> DataFrame:
    read = lambda *path, as_type="variant": J.in_line("_parsed", *path, as_type=as_type, root=value_root)
    parts = parsed.select(
        "*",
        J.in_line("_parsed", root=key_root).alias("_key"),
        normal_op(read("op", as_type="string")).alias("op"),
        *[read(unit, as_type="bigint").alias(f"_{unit}") for unit in ("ts_ms", "ts_us", "ts_ns")],
    )
    parts = parts.select(
        "*",
        # the row a change is about: what it leaves behind, or what a delete took away
        F.when(F.col("op") == DELETE, read("before")).otherwise(read("after")).alias("image"),
        F.col("_ts_ms").alias("ts_ms"),
        F.coalesce("_ts_us", F.try_multiply("_ts_ms", F.lit(1000))).alias("ts_us"),
    )
    parts = parts.withColumn("ts_ns", F.coalesce("_ts_ns", F.try_multiply("ts_us", F.lit(1000))))
    if versions:
        parts = parts.withColumn("_version", read("schema_version", as_type="int"))
        parts = contract.with_violations_by_version(parts, "image", row_schema, versions, "_version")
        unknown = F.col("_version").isNotNull() & ~F.col("_version").isin(*versions)
    else:
        parts, unknown = contract.with_violations(parts, "image", row_schema), F.lit(False)
    faults = [
        *_envelope_faults(has_both, texts),
        _fault("null_key", _null_key("_key", keys)),
        _fault("key_mismatch", _other_key("_key", keys)),
        _fault("unknown_op", F.col("op").isNull()),
        _fault("null_image", J.absent(F.col("image"))),
        _fault("null_order", F.col("ts_ms").isNull() | F.col("ts_ns").isNull()),
        _fault("unknown_schema", unknown),
        _fault("schema_violation", F.size("violations") > 0),
        # only now the image's own key is known to be there and of its type
        _fault("key_mismatch", _another_row("_key", "image", keys)),
    ]
    found = ["reason", "violations", "key_text", *["value_text"] * with_value, "op", "ts_ms", "ts_us", "ts_ns", "image"]
    classified = parts.select(
        *columns,
        F.coalesce(*faults, F.lit(OK)).alias("reason"),
        F.when(~J.absent(F.col("_key")), F.to_json("_key")).alias("key_text"),
        *[F.to_json(read()).alias("value_text")] * with_value,
        *[c for c in found if c not in ("reason", "key_text", "value_text")],
    )
    return _settled(classified, found)


def _parsed(lines: DataFrame, text: str, binary: bool) -> DataFrame:
    """Adds ``_text``, ``_utf8`` and the parsed line."""
    if binary:
        raw = lines.withColumn("_text", J.decoded(text))
        utf8 = F.col(text).isNull() | F.col("_text").isNotNull()
    else:
        raw = lines.withColumn("_text", F.col(text))
        utf8 = F.col(text).isNull() | F.is_valid_utf8(text)
    return raw.withColumn("_utf8", utf8).withColumn("_parsed", J.bracketed("_text"))


def _settled(rows: DataFrame, computed: Sequence[str]) -> DataFrame:
    """The same rows, with the ``computed`` columns as output of a one-row generator.

    A filter on a computed column is otherwise pushed below the projections that lead to
    it and evaluates parsing and checks anew for every place they occur in. It stops at a
    generator, while filters on input columns still reach the scan.
    """
    kept = [c for c in rows.columns if c not in computed]
    return rows.select(*kept, F.inline(F.array(F.struct(*computed))))


def valid(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason") == OK)


def quarantined(classified: DataFrame) -> DataFrame:
    """Faulty rows for the dead-letter store. Blank lines and marks of a partition's end are skipped, not stored."""
    return classified.filter(~F.col("reason").isin(OK, BLANK, END))


def typed(schema: T.StructType) -> str:
    """The schema as type text, with names quoted."""
    return _type_text(schema)


def _type_text(t: T.DataType) -> str:
    if isinstance(t, T.StructType):
        inside = [f"`{f.name.replace('`', '``')}`:{_type_text(f.dataType)}" for f in t.fields]
        return f"struct<{','.join(inside)}>"
    return f"array<{_type_text(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()


def image_rows(classified: DataFrame, row_schema: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """Typed row images of valid events with ``op`` and event time, plus ``carry`` columns."""
    rows = valid(classified).withColumn("_row", F.try_variant_get("image", "$", typed(row_schema)))
    return rows.select(*carry, "_row.*", "op", "ts_ms", "ts_us", "ts_ns")


def key_columns(classified: DataFrame, key_text: str = "key_text") -> DataFrame:
    """Which key columns the messages name, and how often."""
    names = F.array_join(F.array_sort(F.json_object_keys(key_text)), ",")
    return classified.select(names.alias("key_cols")).groupBy("key_cols").agg(F.count("*").alias("n"))


def with_errors(classified: DataFrame, error: str = "error", end_of_partition: str = "_PARTITION_EOF") -> DataFrame:
    """Classified messages with the reasons of those that are a consumer's error: the end of a partition, or a real one."""
    code = F.col(error)
    reason = F.when(code == end_of_partition, END).when(code.isNotNull(), MESSAGE_ERROR).otherwise(F.col("reason"))
    return classified.withColumn("reason", reason)


def error_counts(messages: DataFrame, error: str = "error", end_of_partition: str = "_PARTITION_EOF") -> DataFrame:
    """Per topic partition: good messages, end-of-partition marks, errors."""
    is_eof = F.coalesce(F.col(error) == end_of_partition, F.lit(False))
    return messages.groupBy("partition").agg(
        F.count_if(F.col(error).isNull()).alias("good"),
        F.count_if(is_eof).alias("eof"),
        F.count_if(F.col(error).isNotNull() & ~is_eof).alias("error"),
    )


def _envelope_faults(has_both: Column, texts: int = 1) -> list[Column]:
    return [
        _fault(BLANK, F.col("_utf8") & F.coalesce(J.is_blank("_text"), F.lit(True))),
        _fault("bad_utf8", ~F.col("_utf8")),
        _fault("malformed_json", ~J.is_whole("_parsed", texts)),
        _fault("missing_envelope", ~has_both),
    ]


def _fault(reason: str, condition: Column) -> Column:
    return F.when(condition, F.lit(reason))


def _null_key(key: str, keys: Sequence[str]) -> Column:
    """The key, or one of its columns, is JSON null."""
    nulls = [F.is_variant_null(F.col(key)), *[F.is_variant_null(J.member(key, k)) for k in keys]]
    return reduce(or_, [F.coalesce(n, F.lit(False)) for n in nulls])


def _other_key(key: str, keys: Sequence[str]) -> Column:
    """The key does not name exactly the configured columns."""
    missing = reduce(or_, [J.member(key, k, as_type="string").isNull() for k in keys])
    return missing | ~J.member_count(key).eqNullSafe(F.lit(len(keys)))


def _another_row(key: str, image: str, keys: Sequence[str]) -> Column:
    """The key names another row than the image."""
    differ = [~J.member(key, k, as_type="string").eqNullSafe(J.member(image, k, as_type="string")) for k in keys]
    return reduce(or_, differ)
