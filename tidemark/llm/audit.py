"""Which filter removes what, over every order of the filters, with wide packed counters.

A document's failures are a mask of one bit per filter. Every mask has one big integer: 64-bit fields, four for each
step of each order (kept after it, removed by it, redundant in it, failing it alone), holding 1 where the mask has that
outcome. The integers of a part's documents are summed, and the fields of the sum are the counts: no field can run over into
the next, as none exceeds the number of documents, which is below 2**63. Three sums are kept for a part: of all documents, of
the good and of the toxic ones.

Documents are counted by mask before they are shuffled, so a language with a third of all rows sends a few rows per task, and a
mask's integer is taken as many times as it occurs. Copies are counted by digest in the same way: a
group of copies is one row per part and label before its least id is looked for.

Nulls: a null text is empty (and identical to other empty ones), a null part is the empty string. A null id is smaller than no
other and has no smaller one, so such a row is never a copy. Rows that share the least id of their text are not
copies of each other. A document with several label rows is good or toxic if one of them says so; labels without a
document count nothing. Other columns are not read. A part without documents has no rows, an empty table none at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W

FILTERS = "ABCDE"
COPY = 4  # the bit of the filter that looks at other documents
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_UPPER_PCT = 3
SYMBOLS = b"#$%&*|"
FIELD_BYTES = 8
_SALTS = 4096

OUT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_masks(texts: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """(masks of the filters that need the text alone, digests), of texts without nulls."""
    data, offsets = W.raw_bytes(texts)
    points = W.sums((data & 0xC0) != 0x80, offsets)
    upper = W.sums((data >= ord("A")) & (data <= ord("Z")), offsets)
    marked = np.zeros(256, np.bool_)
    marked[list(SYMBOLS)] = True
    symbols = W.sums(marked[data], offsets)
    whole, n = data.tobytes(), len(texts)
    counts, distinct, digests = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        text = whole[a:b]
        own = text.split()  # of bytes: at the space and U+0009 to U+000D, nowhere else
        counts[k], distinct[k] = len(own), len(set(own))
        digests.append(hashlib.sha256(text).digest())
    failed = (
        counts < MIN_WORDS,
        100 * distinct < MIN_DISTINCT_PCT * counts,
        100 * upper > MAX_UPPER_PCT * points,
        symbols > 0,
    )
    return sum(x.astype(np.int32) << k for k, x in enumerate(failed)), digests


def flagged(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """id, part, digest and mask of every document; the mask lacks the filter on copies."""
    narrow = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            masks, digests = text_masks(W.text_column(piece))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                ["id", "part", "digest", "mask"],
            )

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, part string, digest binary, mask int")


def _join_key(place: str) -> list[Column]:
    """An id, and a salt that spreads the rows without one."""
    salt = F.when(F.col("id").isNull(), 1 + F.pmod(F.xxhash64(place), F.lit(_SALTS))).otherwise(F.lit(0))
    return [F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"), salt.alias("salt")]


def counted(flags: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents by part, whole mask, good and toxic: n."""
    said = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("string").alias("key"), F.lit(0).cast("long").alias("salt"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    rows = flags.groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("*", *_join_key("digest")).join(said, ["key", "salt"], "left")
    copies = rows.groupBy(
        "digest", "part", "mask",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    ).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
    )
    # of a digest there are at most four rows per part
    first = F.min("least.id").over(Window.partitionBy("digest"))
    copies = copies.withColumn("first", first)
    own = F.col("without_id") + F.coalesce(F.when(F.col("least.id") == F.col("first"), F.col("least.n")), F.lit(0))
    ends = F.array(
        F.struct(F.col("mask").alias("mask"), own.alias("n")),
        F.struct((F.col("mask") + (1 << COPY)).alias("mask"), (F.col("n") - own).alias("n")),
    )
    return (
        copies.select("part", "good", "toxic", F.explode(ends).alias("x"))
        .groupBy("part", F.col("x.mask").alias("mask"), "good", "toxic")
        .agg(F.sum("x.n").alias("n"))
    )


class Counters:
    """The big integer of every mask, and what a sum of them says."""

    def __init__(self, filters: str = FILTERS) -> None:
        self.orders = ["".join(x) for x in permutations(filters)]
        self.filters, self.shape = filters, (4, len(self.orders), len(filters))
        self.fields = int(np.prod(self.shape))

    def integer(self, mask: int) -> int:
        said = np.zeros(self.shape, "<u8")
        for o, order in enumerate(self.orders):
            gone = False
            for s, letter in enumerate(order):
                bit = 1 << self.filters.index(letter)
                fails = bool(mask & bit)
                said[:, o, s] = (not (gone or fails), fails and not gone, fails and gone, mask == bit)
                gone |= fails
        return int.from_bytes(said.tobytes(), "little")

    def total(self, counts: Iterable[tuple[int, int]]) -> np.ndarray:
        """The sum of n integers of each mask, unpacked: kept, removed, redundant and unique by order and step."""
        whole, documents = 0, 0
        for mask, n in counts:
            whole += n * self.integer(mask)
            documents += n
        if documents >> 63:
            raise OverflowError(f"{documents} documents do not fit a field")
        return np.frombuffer(whole.to_bytes(self.fields * FIELD_BYTES, "little"), "<u8").astype(np.int64).reshape(self.shape)


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, of documents ``counted`` by mask."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        counters = Counters(filters)
        own = list(zip(*(rows.column(c).to_pylist() for c in ("mask", "n", "good", "toxic")), strict=True))
        kept, removed, redundant, unique = counters.total((m, n) for m, n, _, _ in own)
        good = counters.total((m, n) for m, n, x, _ in own if x)[1]
        toxic = counters.total((m, n) for m, n, _, x in own if x)[1]
        at = np.array([[filters.index(c) for c in order] for order in counters.orders])
        shapley = np.bincount(at.ravel(), removed.ravel(), len(filters)).astype(np.int64)[at]
        n, steps = at.size, len(filters)
        columns = [
            pa.array([key[0].as_py()] * n, pa.string()),
            pa.array([x for x in counters.orders for _ in range(steps)], pa.string()),
            pa.array(np.tile(np.arange(1, steps + 1), len(counters.orders)), pa.int32()),
            *(pa.array(x.ravel(), pa.int64()) for x in (kept, removed, redundant, unique, good, toxic, shapley)),
        ]
        return pa.table(columns, [x.split()[0] for x in OUT.split(", ")])

    return counts.groupBy("part").applyInArrow(run, OUT)


def interactions(
    docs: DataFrame,
    labels: DataFrame,
    flags: Callable[..., DataFrame] = flagged,
    id_col: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """The audit of all documents; ``flags`` says which filters a document fails."""
    return audit(counted(flags(docs, id_col, text, part), labels, id_col))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
