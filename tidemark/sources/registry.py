"""The schema history in a folder: versions are appended, a retired one is a row that says so."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import contract
from tidemark.sources import batches


def read(spark: SparkSession, path: str) -> DataFrame:
    """The history: one row per subject and version."""
    rows = batches.read(spark, path, contract.HISTORY_SCHEMA)
    folded = rows.groupBy("subject", "version").agg(F.max("schema_json").alias("schema_json"), F.bool_or("retired").alias("retired"))
    return folded.select("subject", "version", "schema_json", "retired")


def register(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """Adds a version for every subject of ``new`` whose schema is not its latest; returns what was added.

    ``(subject, version, id)``; an id names a subject's version and stays what it is.
    """
    history = read(spark, path)
    name = batches.append(contract.next_versions(history, new, keep_equal=False), path)
    return _with_id(_batch(spark, path, name))


def replace(spark: SparkSession, path: str, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Retires all versions of the subjects of ``new`` and adds theirs; returns what was added and what was retired."""
    history = read(spark, path)
    retired = history.filter(~F.col("retired")).join(new.select("subject").distinct(), "subject", "left_semi")
    fresh = contract.next_versions(history, new, keep_equal=True)
    name = batches.append(fresh.unionByName(retired.withColumn("retired", F.lit(True)).select(*fresh.columns)), path)
    stored = _batch(spark, path, name)
    return _with_id(stored.filter(~F.col("retired"))), _with_id(stored.filter("retired"))


def _batch(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(contract.HISTORY_SCHEMA).parquet(f"{path}/{batches.BATCH}={name}")


def _with_id(rows: DataFrame) -> DataFrame:
    return rows.select("subject", "version", F.xxhash64("subject", "version").alias("id"))
