"""What the operators share on the Spark side: columns added in Arrow tasks, tables in the shared folder."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W
from tidemark.session import fresh_dir


def annotate(
    df: DataFrame, compute: Callable[[pa.RecordBatch], list], fields: str, into: str, text: str = "text"
) -> DataFrame:
    """df with a struct column ``into`` of ``fields``; ``compute`` makes its arrays for a piece of rows."""
    if into.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"there is a column {into!r} already")
    inner = T._parse_datatype_string(fields)
    names = inner.fieldNames()
    schema = T.StructType([*df.schema.fields, T.StructField(into, inner)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, text):
            made = [x if isinstance(x, pa.Array) else pa.array(x) for x in compute(piece)]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.StructArray.from_arrays(made, names)], [*piece.schema.names, into]
            )

    return df.mapInArrow(run, schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(id_col: str = "doc_id", text: str = "text") -> Column:
    """What a row is known by inside an operator: its id (null sorts first) and a hash of its text.

    Rows that agree in both are one document and get the same result, once per row.
    """
    return F.struct(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
    )


def gather_key() -> Column:
    """A number for what is gathered per row of ``row_key``: its id, spread by its text's hash, so that rows without an id or with
    one that many have are not gathered in one place. Rows that clash share what they gather.
    """
    spread = F.shiftleft(F.col("h").bitwiseAND(F.lit((1 << 20) - 1)), 44)
    return F.when(F.col("id") == F.lit(-(2**63)), F.col("h")).otherwise(F.col("id").bitwiseXOR(spread))


_FILE_BYTES = 4 << 20


def file_limit(df: DataFrame) -> int:
    """Files that a table made from ``df`` is written in at most: four per core, or one for 4 MB of df as Spark estimates it, if more.

    So only small partitions are put together. They are worked through one after the other, and a task holds no more than before.
    An unknown size counts as endless. A file costs more than its rows: on a local file system Hadoop forks the executor
    for it, to set its mode, and what counts an executor's memory just then finds the JVM twice.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = max(32, 4 * df.sparkSession.sparkContext.defaultParallelism, estimate // _FILE_BYTES)
    return min(files, 2**31 - 1)


class Scratch:
    """Tables written below the shared folder, to cut lineage and to be read more than once; in at most ``files`` files, if given."""

    def __init__(self, spark: SparkSession, label: str, files: int | None = None) -> None:
        self.spark, self.root, self.paths, self.files = spark, fresh_dir(spark, label), {}, files

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{len(self.paths)}"
        schema = df.schema
        (df if self.files is None else df.coalesce(self.files)).write.parquet(path)
        del df
        self.paths[name] = path
        self.release()
        return self.spark.read.schema(schema).parquet(path)

    def release(self) -> None:
        """Lets Spark delete the shuffle files of steps that are done: it does so when their plans are collected.

        The scheduler lets go of a job's plan when the next one starts, so there is a small one first.
        """
        self.spark.range(1).count()
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Deletes tables of this object that nothing will read again."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths[name])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
