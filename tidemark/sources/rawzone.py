"""The raw zone: flattened changes in one folder per ingest day.

Parquet by default. In CSV array columns travel as JSON text, because CSV has no arrays.
Reads always take the registered schema: inference would turn the id ``0001`` into 1. A text row that does not fit it,
ragged or of another type, stops a plain read; a checked one gives it back as text, for the dead letters.

A closed day can be compacted: its rows are written once more, in few files, in a folder that Spark's listings leave out, and
the batches they come from are noted. Whoever reads through this module takes the compacted rows and the batches that are not
in them; streams go on reading the batches, and never see a row twice. The batches of a compacted day go later, when
no stream and no reader needs them any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clock
from tidemark.functions.clock import previous_day
from tidemark.sources import batches, feed

DAY = "ingest_date"
BATCH = "ingest_batch"
FAULTY = "_faulty"
MALFORMED = "malformed_row"
FILE_BYTES = 128 << 20
_COMPACTED = "_compacted"
_TAKEN_SCHEMA = "day string, version string, taken string"


def write(
    rows: DataFrame, path: str, fmt: str = "parquet", batch: str | None = None, many_days: bool = True
) -> None:
    """Adds rows to the zone; ``rows`` has the column ``ingest_date``.

    Rows go to a folder of their batch inside each day. A batch that is repeated under its
    name replaces what its first try left; without a name it is always an addition.
    A backfill of ``many_days`` is rebalanced by day, so that not every task writes a file
    for every day; Spark splits a day that is too big for one task. Rows of a single day
    are written from where they are, without a shuffle.
    """
    tagged = _encoded(rows, fmt).withColumn(BATCH, F.lit(batch or uuid.uuid4().hex))
    if many_days:
        tagged = tagged.hint("rebalance", DAY)
    (
        _writer(tagged, fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH)
        .save(path)
    )


def read(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """All days. ``schema`` is that of the rows, without the day."""
    return _decoded(_all_days(spark, path, schema, fmt, checked=False), schema, fmt)


def read_day(spark: SparkSession, path: str, schema: T.StructType, run_date: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The day before the run, by its folder: no other day is listed. A day without folder is empty."""
    return _decoded(_day(spark, path, schema, _day_before(spark, run_date), fmt, checked=False), schema, fmt)


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, run_date: str | None = None, fmt: str = "csv", all_days: bool = False
) -> DataFrame:
    """The day before the run, or all days, with one more column: the text of a row that does not fit the schema.

    That is a row with more or fewer fields, or with one that cannot be read as its type; the other columns
    of such a row mean nothing. Formats that keep types have none.
    """
    if all_days:
        stored = _all_days(spark, path, schema, fmt, checked=True)
    else:
        stored = _day(spark, path, schema, _day_before(spark, run_date), fmt, checked=True)
    if fmt not in _TEXT:
        return _decoded(stored, schema, fmt).withColumn(FAULTY, F.lit(None).cast("string"))
    text = F.col(FAULTY)
    if nested := [f for f in schema.fields if fmt == "csv" and _is_nested(f.dataType)]:
        # a field that is no JSON: the row itself could be read, and its text is put together again
        unread = [F.col(f"`{f.name}`").isNotNull() & F.from_json(F.col(f"`{f.name}`"), f.dataType).isNull() for f in nested]
        whole = F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]), {"quote": '"', "escape": '"'})
        text = F.coalesce(text, F.when(reduce(or_, unread), whole))
    rows = _decoded(stored.withColumn("_text", text), schema, fmt, ["_text"]).withColumnRenamed("_text", FAULTY)
    # a generator takes all columns, whichever are asked for: a field that is not read is not found to be faulty
    return rows.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, without the extra column; texts of the others as column ``raw``)."""
    faulty = F.col(FAULTY).isNotNull()
    return checked.filter(~faulty).drop(FAULTY), checked.filter(faulty).select(F.col(FAULTY).alias("raw"))


def compact(spark: SparkSession, path: str, day: str, schema: T.StructType, fmt: str = "parquet", file_bytes: int = FILE_BYTES) -> int:
    """Scheduled, for a closed day: writes its rows in files of about ``file_bytes``; returns how many batches it took in.

    Nothing is shuffled: small files are read one after the other into the tasks there are to be. The batches there are now are
    noted once the rows are written, so a run that dies is as if it had not been; batches that come later are read
    beside the compacted rows, until the day is compacted again.
    """
    version, taken = _taken(spark, path, day)
    folder = f"{path}/{DAY}={day}"
    there = _existing(spark, lambda: feed.files(spark, folder))
    if there is None:
        return 0
    batch = F.regexp_extract("path", f"{DAY}={day}/{BATCH}=([^/]+)/", 1)
    files = there.select(batch.alias("batch"), "bytes").filter(F.col("batch") != "")
    files = files.groupBy("batch").agg(F.sum("bytes").alias("bytes")).collect()  # one per batch
    new = {r["batch"]: r["bytes"] for r in files if r["batch"] not in taken}
    if not new:
        return 0
    rows = _day(spark, path, schema, day, fmt, checked=False, only=[*taken, *new])
    name = f"{int(version or 0) + 1:06d}"
    parts = max(1, -(-(sum(new.values()) + _compacted_bytes(spark, path, day, version)) // file_bytes))
    _writer(rows.drop(DAY, BATCH).coalesce(parts), fmt).mode("overwrite").save(_compacted_folder(path, day, name))
    note = spark.createDataFrame([(day, name, b) for b in sorted([*taken, *new])], _TAKEN_SCHEMA)
    batches.append(note.coalesce(1), f"{path}/{_COMPACTED}/taken", f"{day}-{name}")
    return len(new)


def drop_compacted(spark: SparkSession, path: str, day: str) -> int:
    """Scheduled, some days later: deletes the batches that were compacted, and older versions; returns how many batches.

    By then no stream may have them still to read, and no reader may have listed them.
    """
    version, taken = _taken(spark, path, day)
    for batch in taken:
        batches.delete(spark, f"{path}/{DAY}={day}/{BATCH}={batch}")
    for n in range(1, int(version or 0)):
        batches.delete(spark, _compacted_folder(path, day, f"{n:06d}"))
    return len(taken)


def stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """New raw files as they land."""
    reader = _reader(spark.readStream, fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _decoded(reader.schema(_stored(schema, fmt)).load(path), schema, fmt)


def day_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(DAY).agg(F.count("*").alias("n"))


def _is_nested(t: T.DataType) -> bool:
    return isinstance(t, T.ArrayType | T.StructType | T.MapType)


def _encoded(rows: DataFrame, fmt: str) -> DataFrame:
    if fmt != "csv":
        return rows
    return rows.select(
        *[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if _is_nested(f.dataType) else F.col(f"`{f.name}`") for f in rows.schema.fields]
    )


def _day_before(spark: SparkSession, run_date: str | None) -> str:
    return spark.range(1).select(clock.day_label(previous_day(run_date)).alias("d")).first()["d"]


def _existing(spark: SparkSession, load: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return load()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _taken(spark: SparkSession, path: str, day: str | None = None) -> tuple[str | None, list[str]]:
    """(newest compacted version of a day, the batches in it); both come to the driver, which lists the batches anyhow."""
    rows = batches.read(spark, f"{path}/{_COMPACTED}/taken", _TAKEN_SCHEMA).filter(F.col("day") == day).collect()
    version = max((r["version"] for r in rows), default=None)
    return version, [r["taken"] for r in rows if r["version"] == version]


def _compacted_folder(path: str, day: str, version: str) -> str:
    return f"{path}/{_COMPACTED}/data/{day}/{version}"


def _compacted_bytes(spark: SparkSession, path: str, day: str, version: str | None) -> int:
    if version is None:
        return 0
    return feed.files(spark, _compacted_folder(path, day, version)).agg(F.sum("bytes").alias("n")).first()["n"] or 0


def _compacted(spark: SparkSession, path: str, schema: T.StructType, day: str, version: str, fmt: str, checked: bool) -> DataFrame:
    stored = T.StructType([f for f in _stored(schema, fmt, checked).fields if f.name not in (DAY, BATCH)])
    rows = _reader(spark.read, fmt, checked).schema(stored).load(_compacted_folder(path, day, version))
    return rows.withColumns({DAY: F.to_date(F.lit(day)), BATCH: F.lit(None).cast("string")})


def _day(
    spark: SparkSession, path: str, schema: T.StructType, day: str, fmt: str, checked: bool, only: list[str] | None = None
) -> DataFrame:
    """Stored rows of a day: the compacted ones, and the batches that are not in them, of ``only`` some if named."""
    version, taken = _taken(spark, path, day)
    reader = _reader(spark.read, fmt, checked).option("basePath", path)
    rows = _existing(spark, lambda: reader.schema(_stored(schema, fmt, checked)).load(f"{path}/{DAY}={day}"))
    if rows is not None and only is not None:
        rows = rows.filter(F.col(BATCH).isin(only))
    if version is None:
        return spark.createDataFrame([], _stored(schema, fmt, checked)) if rows is None else rows
    done = _compacted(spark, path, schema, day, version, fmt, checked)
    return done if rows is None else done.unionByName(rows.filter(~F.col(BATCH).isin(taken)))


def _all_days(spark: SparkSession, path: str, schema: T.StructType, fmt: str, checked: bool) -> DataFrame:
    rows = _reader(spark.read, fmt, checked).schema(_stored(schema, fmt, checked))
    notes = batches.read(spark, f"{path}/{_COMPACTED}/taken", _TAKEN_SCHEMA)
    newest = notes.groupBy("day").agg(F.max("version").alias("version")).collect()  # one per compacted day
    if not newest:
        return rows.load(path)
    dropped = [f"{r['day']}/{r['taken']}" for r in notes.select("day", "taken").distinct().collect()]
    place = F.concat_ws("/", F.col(DAY).cast("string"), F.col(BATCH))
    rest = _existing(spark, lambda: rows.load(path).filter(~place.isin(dropped)))
    parts = [_compacted(spark, path, schema, r["day"], r["version"], fmt, checked) for r in newest]
    return reduce(DataFrame.unionByName, parts if rest is None else [rest, *parts])


def _decoded(stored: DataFrame, schema: T.StructType, fmt: str, more: Sequence[str] = ()) -> DataFrame:
    def column(f: T.StructField) -> Column:
        if fmt == "csv" and _is_nested(f.dataType):
            return F.from_json(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
        return F.col(f"`{f.name}`")

    return stored.select(*[column(f) for f in schema.fields], DAY, *more)


def _stored(schema: T.StructType, fmt: str, checked: bool = False) -> T.StructType:
    fields = [
        T.StructField(f.name, T.StringType() if fmt == "csv" and _is_nested(f.dataType) else f.dataType)
        for f in schema.fields
    ]
    if checked and fmt in _TEXT:
        fields.append(T.StructField(FAULTY, T.StringType()))
    return T.StructType([*fields, T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.StringType())])


# Text may hold quotes, line breaks, backslashes and blanks at its ends: fields are quoted, a
# quote inside is doubled, a field may span lines, and nothing is trimmed.
# A field that spans lines keeps a file from being split: a file is one task, so its rows are bounded. So many
# rows of 13 KB, as whole documents are with their words as arrays, are 260 MB.
_MAX_CSV_ROWS = 20_000
_TEXT = ("csv", "json")
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _writer(rows: DataFrame, fmt: str):
    writer = rows.write.format(fmt)
    return writer.options(**_CSV, maxRecordsPerFile=_MAX_CSV_ROWS) if fmt == "csv" else writer


def _reader(reader, fmt: str, checked: bool = False):
    reader = reader.format(fmt)
    if fmt in _TEXT:
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=FAULTY) if checked else reader.option("mode", "FAILFAST")
    # an unquoted empty field is null and a quoted one an empty text; with the default
    # null marker, which is empty too, both would read as null
    return reader.options(**_CSV, nullValue="\u0000") if fmt == "csv" else reader
