"""Append-only tables: plain Parquet, one folder per batch.

A batch that is written again under its name replaces its first try, so a repeated micro-batch
leaves no second copy; without a name it is an addition. What the rows mean together is up to who reads them:
the last change per key, the largest mark, the last word on a dead letter. What a batch costs depends on the
batch alone; a scheduled rewrite (:func:`rewrite`) keeps the number of folders down.

A rewrite counts from the moment its note is there, which names the batches it stands for: readers then take it and leave those out, never
both and never neither. The batches go with the next rewrite, so that whoever has listed them can finish.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch"
_REWRITE = "rewrite-"
_NOTES = "_rewrites"
_NOTE_SCHEMA = "rewrite string, replaced string"


def append(rows: DataFrame, path: str, batch: str | None = None) -> str:
    """Adds a batch; returns its name."""
    name = batch or uuid.uuid4().hex
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={name}")
    return name


def read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all batches, none for a new table."""
    found = _counting(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found.drop(BATCH)


def names(spark: SparkSession, path: str) -> list[str]:
    """The batches there are; one name per folder comes to the driver."""
    found = _counting(spark, path, T.StructType())
    return [] if found is None else sorted(r[BATCH] for r in found.select(BATCH).distinct().collect())


def rewrite(rows: DataFrame, path: str, replaced: Sequence[str]) -> str:
    """Stores ``rows``, which stand for the batches named; these go when the next rewrite is made.

    For one rewriting job at a time; appending ones may be many. A job that dies leaves the batches as they were.
    """
    spark = rows.sparkSession
    done, gone = _notes(spark, path)
    there = _stored(spark, path, T.StructType())
    held = {r[BATCH] for r in there.select(BATCH).distinct().collect()} if there is not None else set()
    # what earlier rewrites stand for, and rewrites that died before their note
    stale = sorted(held & gone) + sorted(b for b in held if b.startswith(_REWRITE) and b not in done)
    name = append(rows, path, f"{_REWRITE}{uuid.uuid4().hex}")
    note = spark.createDataFrame([(name, b) for b in replaced] or [(name, None)], _NOTE_SCHEMA)
    append(note.coalesce(1), f"{path}/{_NOTES}", name)
    remove(spark, path, stale)
    return name


def remove(spark: SparkSession, path: str, replaced: Sequence[str]) -> None:
    """Deletes batches. A reader that has listed them before fails; it is run again."""
    for old in replaced:
        delete(spark, f"{path}/{BATCH}={old}")


def delete(spark: SparkSession, folder: str) -> None:
    """Deletes a folder on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _notes(spark: SparkSession, path: str) -> tuple[set[str], set[str]]:
    """(rewrites that count, batches they stand for); one name per folder comes to the driver."""
    found = _stored(spark, f"{path}/{_NOTES}", _NOTE_SCHEMA)
    rows = [] if found is None else found.select("rewrite", "replaced").collect()
    return {r["rewrite"] for r in rows}, {r["replaced"] for r in rows if r["replaced"] is not None}


def _counting(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The stored batches that count; the others' folders are not read."""
    found = _stored(spark, path, schema)
    if found is None:
        return None
    done, gone = _notes(spark, path)
    counts = ~F.col(BATCH).startswith(_REWRITE)
    if done:
        counts = (counts | F.col(BATCH).isin(sorted(done))) & ~F.col(BATCH).isin(sorted(gone))
    return found.filter(counts)


def _stored(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    try:
        return spark.read.schema(T.StructType([*fields.fields, T.StructField(BATCH, T.StringType())])).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def exact(spark: SparkSession, path: str, batch: str, schema: T.StructType) -> DataFrame:
    """The rows of one batch."""
    return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batch}")


def latest_name(spark: SparkSession, path: str, before: str | None = None) -> str | None:
    """The greatest batch name, or the greatest below ``before``."""
    found = _stored(spark, path, T.StructType())
    if found is None:
        return None
    wanted = found if before is None else found.filter(F.col(BATCH) < before)
    return wanted.agg(F.max(BATCH).alias("b")).first()["b"]
