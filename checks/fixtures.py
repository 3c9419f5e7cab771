"""CDC inputs derived from the given tables. Every one covers its whole table.

The same inputs are written as SQL in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import FeedConfig
from tidemark.functions import clock
from tidemark.operators.changes import latest

KEYS, ORDER = ["user_id"], ["ts", "seq"]
ROW = ["user_id", "event_type", "value", "props"]
# a key that many batches leave alone: with it every cell of the merges' truth table is filled
SLOT_KEYS = ["user_id", "slot"]
SLOT_ROW = ["user_id", "slot", "event_type", "value", "props"]
SLOTS = 16

# Row contract of the events feed.
LINE_SCHEMA = T.StructType().add("id", "string").add("v", "double")
FEED = FeedConfig(feed="events", row_schema=LINE_SCHEMA, keys=("id",), topic="events")

PART_KEYS = ["l_orderkey", "l_linenumber"]
PART_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "op",
              "l_linestatus"]
PART_ROW = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# compressed columns of 128 MiB, a split of the scan, are several times as much text
_TASKS_PER_SPLIT = 4


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a table for costly work per row: over all cores, though it may be one row group, and in more tasks the larger it is."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, _TASKS_PER_SPLIT * rows.rdd.getNumPartitions()))


def moment(text: str) -> Column:
    """A literal the Parquet scan can push a filter on."""
    return F.to_timestamp_ntz(F.lit(text))


CUT = "2024-01-15 00:00:00"
BROKER_DOWN = "2024-01-20 00:00:00"


# ---------------------------------------------------------------- changes of users


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as changes of their user: signup inserts, error deletes, the rest updates."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, sf_dir, "events").select(*ROW, op.alias("op"), "ts", F.col("event_id").alias("seq"))


def slot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as changes of a user's slots."""
    return changelog(spark, sf_dir).withColumn("slot", F.col("seq") % SLOTS).select(*SLOT_ROW, "op", "ts", "seq")


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of slots from the cut on."""
    return slot_changes(spark, sf_dir).filter(F.col("ts") >= moment(CUT))


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slots as they are just before the cut."""
    before = slot_changes(spark, sf_dir).filter(F.col("ts") < moment(CUT))
    return latest(before, SLOT_KEYS, ORDER).filter(F.col("op") != "D").select(*SLOT_ROW)


def latest_per_kind(spark: SparkSession, sf_dir: str, op: str) -> DataFrame:
    return latest(batch(spark, sf_dir).filter(F.col("op") == op), SLOT_KEYS, ORDER)


# ---------------------------------------------------------------- changes of order lines


def line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of lineitem as changes of a two-column key."""
    flag = F.col("l_returnflag")
    op = F.when(flag == "N", "I").when(flag == "R", "D").otherwise("U")
    return table(spark, sf_dir, "lineitem").withColumn("op", op)


LINE_CUT = "1999-01-01 00:00:00"


def line_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = line_changes(spark, sf_dir).filter(F.col("l_shipdate") < moment(LINE_CUT))
    before = before.select(*dict.fromkeys([*PART_ROW, *PART_ORDER]))
    return latest(before, PART_KEYS, PART_ORDER).filter(F.col("op") != "D").select(*PART_ROW)


def line_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_changes(spark, sf_dir).filter(F.col("l_shipdate") >= moment(LINE_CUT))


# ---------------------------------------------------------------- feed lines


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def lines(spark: SparkSession, sf_dir: str, faults: bool = False, cut: bool = True) -> DataFrame:
    """One feed line per event: ``event_id, ts, line``.

    Always: lines without ``value``, and with ``cut`` also cut-off and blank ones, by ``event_id``. With
    ``faults`` also the faults a key, an operation, an image or a row contract can have.
    """
    ids = F.col("user_id").cast("string")
    op = F.when(F.col("event_type") == "signup", "i").when(F.col("event_type") == "error", "d").otherwise("u")
    us = clock.micros("ts")

    def case(normal: Column | str, *odd: tuple[int, Column | str]) -> Column:
        normal = F.lit(normal) if isinstance(normal, str) else normal
        for n, other in reversed(odd):
            normal = F.when(_every(n) & F.lit(faults), F.lit(other) if isinstance(other, str) else other).otherwise(normal)
        return normal

    key = case(F.concat(F.lit('{"id":"'), ids, F.lit('"}')),
               (29, "null"), (31, F.concat(F.lit('{"uid":"'), ids, F.lit('"}'))))
    code = case(op, (37, "x"))
    time = case(F.concat(F.lit('"ts_ms":'), clock.millis("ts").cast("string"),
                         F.lit(',"ts_us":'), us.cast("string"),
                         F.lit(',"ts_ns":'), (us * 1000).cast("string"), F.lit(",")),
                (61, ""))
    before = case(op == "d", (41, op != "d"))
    side = F.when(before, "before").otherwise("after")
    image_id = case(F.concat(F.lit('"'), ids, F.lit('"')), (43, ids))
    v = case(F.concat(F.lit(',"v":'), F.col("value").cast("string")),
             (47, ""), (53, ',"v":null'), (59, ',"v":"text"'))
    extra = case("", (71, ',"extra":1'))
    body = F.when(_every(23), "payload").otherwise("value")
    line = F.concat(
        F.lit('{"key":'), key, F.lit(',"'), body, F.lit('":{"op":"'), code, F.lit('",'), time,
        F.lit('"'), side, F.lit('":{"id":'), image_id, v, extra, F.lit("}}}"),
    )
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return dealt(events).select(
        "event_id",
        "ts",
        (F.when(_every(17), F.substring(line, 1, 20)).when(_every(19), "").otherwise(line) if cut else line).alias("line"),
    )


def versioned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty lines, from the cut on under a second schema version, which some do not name and some misname."""
    rows = lines(spark, sf_dir, faults=True)
    named = F.when(_every(83), "9").when(_every(7), "").when(F.col("ts") >= moment(CUT), "2").otherwise("1")
    member = F.when(named == "", "").otherwise(F.concat(F.lit('"schema_version":'), named, F.lit(",")))
    return rows.withColumn("line", F.replace("line", F.lit('{"op":'), F.concat(F.lit("{"), member, F.lit('"op":'))))


# the second version asks for a field that few events have
SECOND_SCHEMA = T.StructType([*LINE_SCHEMA.fields, T.StructField("extra", T.LongType())])


def line_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty lines as bytes, some of them not UTF-8."""
    raw = F.encode("line", "UTF-8")
    return lines(spark, sf_dir, faults=True).select(
        "event_id", "ts", F.when(_every(67), F.concat(F.unhex(F.lit("FFFE")), raw)).otherwise(raw).alias("line")
    )


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty lines as topic messages: key and value on their own, some without a key, some not UTF-8.

    Cut-off and blank lines have a value of that kind; a line without ``value`` has none.
    """
    whole = lines(spark, sf_dir, faults=True, cut=False)
    key, value = F.get_json_object("line", "$.key"), F.get_json_object("line", "$.value")
    raw = F.when(_every(17), F.substring(value, 1, 20)).when(_every(19), "").otherwise(value)
    raw = F.encode(raw, "UTF-8")
    return whole.select(
        F.when(~_every(73) & ~_every(19), F.encode(key, "UTF-8")).alias("key"),
        F.when(_every(67), F.concat(F.unhex(F.lit("FFFE")), F.coalesce(raw, F.lit(b"")))).otherwise(raw).alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as messages of a topic with four partitions.

    The event number serves as offset: it grows within every partition, as offsets do,
    and like those of a compacted topic it has gaps.
    """
    error = F.when(_every(50), "_PARTITION_EOF").when(_every(97), "_MSG_TIMED_OUT")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        error.alias("error"),
    )


def relayed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty messages with ends of partitions and errors among them, which have neither key nor value."""
    sent = faulty_messages(spark, sf_dir)
    error = F.when(F.col("offset") % 50 == 0, "_PARTITION_EOF").when(F.col("offset") % 97 == 0, "_MSG_TIMED_OUT")
    given = lambda c: F.when(error.isNull(), F.col(c)).alias(c)
    return sent.select(given("key"), given("value"), "topic", "partition", "offset", "timestamp", error.alias("error"))


# ---------------------------------------------------------------- nested documents


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as nested rows of the sample schema: words and lines as arrays of structs."""

    def items(separator: str) -> Column:
        return F.transform(
            F.split("text", separator),
            lambda part, i: F.struct(i.cast("string").alias("id"), part.alias("type")),
        )

    return dealt(table(spark, sf_dir, "documents")).select(
        F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("id"),
        F.col("lang").alias("type"),
        F.col("source").alias("name"),
        (F.col("n_chars") / F.lit(4.0)).alias("ppu"),
        F.struct(items(" ").alias("batter")).alias("batters"),
        items("\n").alias("topping"),
    )


def deep_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, two array levels deep: lines that hold words."""
    words = lambda line: F.transform(F.split(line, " "), lambda w: F.struct(w.alias("word")))
    return dealt(table(spark, sf_dir, "documents")).select(
        F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("id"),
        F.struct("lang", F.struct("source", "n_chars").alias("origin")).alias("meta"),
        F.transform(
            F.split("text", "\n"),
            lambda line, i: F.struct(i.cast("string").alias("id"), words(line).alias("part")),
        ).alias("lines"),
    )


# ---------------------------------------------------------------- schema history


def schema_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subject per part with one to three versions; the first may be retired."""
    versions = F.explode(F.sequence(F.lit(1), F.col("p_size") % 3 + 1))
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", "p_size", versions.alias("version"))
        .select(
            subject(),
            "version",
            schema_text(F.col("version")),
            ((F.col("version") == 1) & (F.col("p_size") % 2 == 0) & (F.col("p_size") % 3 > 0)).alias("retired"),
        )
    )


def new_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema for every part and supplier: even parts repeat their latest one."""
    parts = table(spark, sf_dir, "part")
    latest_version = F.col("p_size") % 3 + 1
    repeated = F.when(F.col("p_partkey") % 2 == 0, latest_version).otherwise(latest_version + 10)
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.col("s_name"), F.lit("-value")).alias("subject"), F.lit('{"v":1}').alias("schema_json")
    )
    return parts.select(subject(), schema_text(repeated)).unionByName(suppliers)


def subject() -> Column:
    return F.concat(F.lit("part"), F.col("p_partkey").cast("string"), F.lit("-value")).alias("subject")


def schema_text(version: Column) -> Column:
    return F.concat(F.lit('{"v":'), version.cast("string"), F.lit("}")).alias("schema_json")


# ---------------------------------------------------------------- raw text rows with faults


RAW_SCHEMA = T.StructType().add("event_id", "long").add("user_id", "long").add("value", "double").add("tags", T.ArrayType(T.StringType()))


def raw_text_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows of four text fields, some of another type than they should be; rows that lack two fields)."""
    tags = F.to_json(F.array("event_type"))
    whole = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(_every(13), F.concat(F.lit("u"), F.col("user_id"))).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(_every(17), "n, \"a\"").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(_every(19), F.substring(tags, 1, 3)).otherwise(tags).alias("tags"),
    )
    ragged = F.col("event_id") % 11 == 0
    return whole.filter(~ragged), whole.filter(ragged).select("event_id", "user_id")


class DiesOnce:
    """A sink whose method does its work and then fails, the first time it is called for the second batch."""

    def __init__(self, sink, method: str) -> None:
        self._sink, self._method, self._failures = sink, method, [ConnectionError("executor lost")]

    def __getattr__(self, name: str):
        own = getattr(self._sink, name)
        if name != self._method:
            return own

        def dying(rows: DataFrame, batch: str) -> None:
            own(rows, batch)
            if batch.endswith("-1") and self._failures:
                raise self._failures.pop()

        return dying


def restarted(attempt) -> None:
    """Runs a job that dies once, and runs it again."""
    try:
        attempt()
    except Exception as failure:  # noqa: BLE001 - as Spark reports it
        if "executor lost" not in str(failure):
            raise
        attempt()
    else:
        raise AssertionError("the planted failure did not come")
