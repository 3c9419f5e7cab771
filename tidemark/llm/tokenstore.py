"""Token ids in ORC files: integer run-length encoding, row indexes, and Bloom filters on document ids.

Documents are dealt out by ranges of their id and sorted, then encoded and written in the same task, so the text moves once
and the ids never do. A file holds one range: ``part`` (constant), ``doc_id`` and ``start`` (both ascending: a few bits a row
under run-length encoding), ``n_tokens`` and ``ids``. Every ``stride`` rows have an entry of least and greatest id and a Bloom
filter in the stripe's index. A table of parts beside them says how many ids lie before each part, so that any
stripe can be read alone and still knows its place among all ids.

``read`` goes stripe by stripe in as many tasks as Spark cuts the files into; a list of document ids is pushed down
to the indexes, and stripes and row groups without them are not read.

Nulls: a null text is empty and consists of its closing id; a null id comes first. Rows of one id come in the order of a
hash of their text, so the store does not depend on how the input was cut; equal rows are stored once each, and a
third of all rows may have one id. Other columns are not stored. An empty table gives a store without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import packing
from tidemark.llm import words as W
from tidemark.session import fresh_dir

STRIPE_BYTES = 64 << 20
STRIDE = 1000
FALSE_HITS = 0.01
#: Parts are files of the store; a table of so many takes some 30 MB in memory.
BROADCAST_PARTS = 1_000_000
_PIECE = 6 << 20
_SCHEMA = "part int, doc_id {kind}, start long, n_tokens long, ids array<int>"


@cache
def _encoder(tokenizer: str) -> packing.WordEncoder:
    """One per worker, which keeps the words of earlier tasks, as far as the encoder keeps any."""
    return packing.WordEncoder(tokenizer)


def encoded(docs: DataFrame, tokenizer: str, end_id: int = packing.END_ID, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The store's rows in order: ranges of ids, sorted, each with its ids and how many of the part lie before them."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
        F.monotonically_increasing_id().alias("place"),
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "h", "place"]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for piece in W.pieces(batches, limit=_PIECE):
            ids, offsets = packing.encode_documents(W.text_column(piece), encoder, end_id)
            arrays = [
                pa.array(np.full(piece.num_rows, part, np.int32)),
                piece.column("doc_id"),
                pa.array(before + offsets[:-1]),
                pa.array(np.diff(offsets)),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32))),
            ]
            before += int(offsets[-1])
            yield pa.RecordBatch.from_arrays(arrays, ["part", "doc_id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, _SCHEMA.format(kind=rows.schema["doc_id"].dataType.simpleString()))


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = packing.END_ID,
    stripe_bytes: int = STRIPE_BYTES,
    stride: int = STRIDE,
    id_col: str = "doc_id",
    text: str = "text",
) -> None:
    """Stores all documents below ``path``: ``ids``, one file per range, and ``parts``."""
    spark = docs.sparkSession
    files = encoded(docs, tokenizer, end_id, id_col, text)
    (
        files.write.option("orc.create.index", "true")
        .option("orc.row.index.stride", str(stride))
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.rows.between.memory.checks", str(stride))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(FALSE_HITS))
        .orc(f"{path}/ids")
    )
    # reads two short columns; one row per file is left when the parts meet in a task
    parts = (
        spark.read.schema(files.schema).orc(f"{path}/ids")
        .groupBy("part")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.sum("n_tokens").alias("n_tokens"),
            F.min("doc_id").alias("first_id"),
            F.max("doc_id").alias("last_id"),
        )
    )
    ahead = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts.withColumn("part_start", F.coalesce(ahead, F.lit(0))).coalesce(1).write.orc(f"{path}/parts")


def read(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids; of the documents named, if any are."""
    rows = spark.read.orc(f"{path}/ids")
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(doc_ids))
    parts = spark.read.orc(f"{path}/parts").select("part", "part_start")
    if parts.count() <= BROADCAST_PARTS:
        parts = F.broadcast(parts)
    return rows.join(parts, "part").select("doc_id", (F.col("part_start") + F.col("start")).alias("start"), "n_tokens", "ids")


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of rows that were read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets)), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "start", "ids").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of all documents, and reads back what was written."""
    path = fresh_dir(spark, "token-ids")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, packing.default_path())
    return checksums(read(spark, path))
