"""Hard negatives by vertical scans: dimension after dimension, with bounds on what the rest can still add (BOND).

Vectors become integers, floor(scale * x), and are dealt to shards of bounded bytes; anchors to blocks of bounded bytes. Every block
meets every shard in a task of its own. There the shard lies as columns, with the least and greatest value of each. For an
anchor the columns are read in descending order of its components' size, some at a time; what the unread columns can add lies
between two sums of its components with the columns' extremes. A candidate goes when it can no longer be among the best
positives, or can lie in no window, or in none where it could be among the first. What is left when all columns are read
has exact scores. Sums are exact: double precision below 2**53, else 64-bit integers, else an error is raised.

Two rounds: the positives of each anchor first, over all shards; then the windows that their scores span. A shard gives at most
``n_negatives`` rows for a window, and the best of all shards are taken by anchor.

Nulls: a row with a null label, a null vector, or a null or non-finite component takes no part. A null id is the smallest and no
anchor. Vectors of different length never meet. Repeated rows are rows of their own, ties among them in the order in which they were
read; a repeated anchor gives its rows as often. The id -2**63 stands for null inside. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import Scratch

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score
SCALE = 256
BLOCK_BYTES = 32 << 20  # of a shard's vectors, and of a block's anchors
SPREAD_ROWS = 4096  # shards are not made smaller than this to use more cores
STEP = 8  # columns read between two looks at the bounds
_NO_ID = -(2**63)
_KEYS = ("dim", "shard", "block")


def usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False))


def quantized(vectors: pa.ChunkedArray, dim: int, scale: int) -> np.ndarray:
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in vectors.chunks]
    flat = np.concatenate(flat) if flat else np.zeros(0)
    return np.floor(scale * flat.astype(np.float64)).reshape(len(vectors), dim)


class Shard:
    """Rows as columns, sorted by label and id, with the columns' extremes."""

    def __init__(self, rows: pa.Table, dim: int, scale: int, anchors: np.ndarray) -> None:
        ids = rows.column("id").to_numpy()
        labels, places = rows.column("label").to_numpy(), rows.column("place").to_numpy()
        order = np.lexsort((places, ids, labels))
        self.ids, self.labels, self.places = ids[order], labels[order], places[order]
        columns = np.ascontiguousarray(quantized(rows.column("vector"), dim, scale)[order].T)
        reach = np.abs(columns).max(axis=1, initial=0) @ np.abs(anchors).max(axis=0, initial=0)
        if not reach < 2.0**62:
            raise OverflowError("the scores of these vectors do not fit 64 bits")
        self.kind = np.float64 if reach < 2.0**53 else np.int64
        self.columns = columns.astype(self.kind)
        self.extremes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def range_of(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def scan(self, anchor: np.ndarray, rows: np.ndarray, span: tuple[int, int], prune: Callable) -> tuple[np.ndarray, np.ndarray]:
        """(rows left, their exact scores): columns in descending order of the anchor's components.

        ``prune(scores, low, high)`` says which candidates stay, when the unread columns add between low and high.
        """
        if not len(rows):
            return rows, np.zeros(0, np.int64)
        if span not in self.extremes:
            part = self.columns[:, span[0] : span[1]]
            self.extremes[span] = part.min(axis=1), part.max(axis=1)
        anchor = anchor.astype(self.kind)
        order = np.argsort(-np.abs(anchor), kind="stable")
        a, (least, most) = anchor[order], self.extremes[span]
        ends = np.stack([a * least[order], a * most[order]])
        low, high = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (ends.min(axis=0), ends.max(axis=0)))
        scores = np.zeros(len(rows), self.kind)
        for k in range(0, len(order), STEP):
            if not len(rows):
                break
            read = order[k : k + STEP]
            scores += a[k : k + STEP] @ self.columns[read[:, None], rows]
            end = min(k + STEP, len(order))
            if end < len(order):
                stay = prune(scores, low[end], high[end])
                if not stay.all():
                    rows, scores = rows[stay], scores[stay]
        return rows, scores.astype(np.int64)

    def first(self, rows: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        """Places in ``rows`` of the n best, smaller ids first among equals."""
        return np.lexsort((self.places[rows], self.ids[rows], -scores))[:n]


def _best(n: int) -> Callable:
    def stay(scores: np.ndarray, low: float, high: float) -> np.ndarray:
        if len(scores) <= n:
            return np.ones(len(scores), np.bool_)
        nth = np.partition(scores, len(scores) - n)[len(scores) - n]
        return scores + high >= nth + low

    return stay


def _in_windows(windows: list[tuple[int, int]], n: int) -> Callable:
    def stay(scores: np.ndarray, low: float, high: float) -> np.ndarray:
        out = np.zeros(len(scores), np.bool_)
        for least, most in windows:
            may = (scores + high >= least) & (scores + low <= most)
            sure = scores[(scores + low >= least) & (scores + high <= most)]
            if len(sure) >= n:
                may &= scores + high >= np.partition(sure, len(sure) - n)[len(sure) - n] + low
            out |= may
        return out

    return stay


def positives_in(shard: Shard, anchor: np.ndarray, label: int, place: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the shard's n best of the same label, the anchor's own row left out."""
    span = shard.range_of(label)
    rows = np.arange(*span)
    rows, scores = shard.scan(anchor, rows[shard.places[rows] != place], span, _best(n))
    at = shard.first(rows, scores, n)
    return rows[at], scores[at]


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def negatives_in(shard: Shard, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (rows, scores) of the shard's n best of other labels in it."""
    a, b = shard.range_of(label)
    rows = np.concatenate([np.arange(a), np.arange(b, len(shard.ids))])
    rows, scores = shard.scan(anchor, rows, (0, len(shard.ids)), _in_windows([x for x in windows if x[0] <= x[1]], n))
    out = []
    for least, most in windows:
        own = np.flatnonzero((scores >= least) & (scores <= most))
        at = own[shard.first(rows[own], scores[own], n)]
        out.append((rows[at], scores[at]))
    return out


def _met(vectors: DataFrame, anchors: DataFrame, shards: int, blocks: int, run: Callable, schema: str) -> DataFrame:
    """Every block of anchors with every shard, a group each: ``run(shard, anchors, vectors of the anchors)``."""
    at = F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int")
    left = vectors.select(
        "dim", (F.col("place") % shards).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "place", "id", "label", "vector",
    )
    right = anchors.select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), at.alias("block"),
        *[c for c in anchors.columns if c != "dim"],
    )

    def both(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        dim, made = key[0].as_py(), []
        if rows.num_rows and asked.num_rows:
            wanted = quantized(asked.column("vector"), dim, SCALE)
            made = run(Shard(rows, dim, SCALE, wanted), asked, wanted)
        names = [x.split()[0] for x in schema.split(", ")]
        columns = zip(*made, strict=True) if made else [[] for _ in names]
        return pa.table([pa.array(list(x), pa.int64()) for x in columns], names)

    return left.groupBy(*_KEYS).cogroup(right.groupBy(*_KEYS)).applyInArrow(both, schema)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
    spread_rows: int = SPREAD_ROWS,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = vectors.where(usable(F.col(vector), F.col(label))).select(
        F.monotonically_increasing_id().alias("place"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.col(label).cast("long").alias("label"),
        F.size(vector).alias("dim"),
        F.col(vector).alias("vector"),
        (F.coalesce(is_anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("is_anchor"),
    )
    rows = scratch.table(rows, "vectors")
    wanted = F.when(F.col("is_anchor"), F.col("dim") * F.lit(4) + 24)
    n, own, asked = rows.agg(F.count(F.lit(1)), F.sum(F.col("dim") * F.lit(4) + 24), F.sum(wanted)).first()
    cores = spark.sparkContext.defaultParallelism
    shards = max(1, math.ceil((own or 0) / block_bytes), min(2 * cores, math.ceil(n / spread_rows)))
    blocks = max(1, math.ceil((asked or 0) / block_bytes))
    anchors = scratch.table(rows.where("is_anchor").select("dim", "place", "label", "vector", "id"), "anchors")
    rows = rows.drop("is_anchor")

    def find_positives(shard: Shard, asked: pa.Table, wanted: np.ndarray) -> list[tuple]:
        made = []
        for k, (place, label) in enumerate(zip(asked.column("place").to_pylist(), asked.column("label").to_pylist(), strict=True)):
            found, scores = positives_in(shard, wanted[k], label, place, n_positives)
            made += [(place, int(shard.ids[x]), int(shard.places[x]), s) for x, s in zip(found, scores.tolist(), strict=True)]
        return made

    found = _met(rows, anchors, shards, blocks, find_positives, "anchor long, id long, at long, score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "at")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= n_positives)
    found = scratch.table(
        found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("found")), "positives"
    )  # at most n_positives each
    with_windows = anchors.withColumnRenamed("id", "anchor_id").join(found, F.col("place") == F.col("anchor")).drop("anchor")

    def find_negatives(shard: Shard, asked: pa.Table, wanted: np.ndarray) -> list[tuple]:
        made = []
        for k, (place, anchor_id, label, own) in enumerate(
            zip(*(asked.column(c).to_pylist() for c in ("place", "anchor_id", "label", "found")), strict=True)
        ):
            windows = [window(x["score"], low, high) for x in own]
            for x, (at, scores) in zip(own, negatives_in(shard, wanted[k], label, windows, n_negatives), strict=True):
                made += [
                    (place, anchor_id, x["nth"], x["id"], x["score"], int(shard.ids[y]), int(shard.places[y]), s)
                    for y, s in zip(at, scores.tolist(), strict=True)
                ]
        return made

    schema = "anchor long, anchor_id long, nth long, positive_id long, positive_score long, id long, at long, score long"
    near = _met(rows, with_windows, shards, blocks, find_negatives, schema)
    best = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id", "at")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    shown = [F.when(F.col(c) != _NO_ID, F.col(c)).alias(out) for c, out in (("positive_id", "positive_id"), ("id", "negative_id"))]
    return near.select("anchor_id", shown[0], "rank", shown[1], "positive_score", F.col("score").alias("negative_score"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are every hundredth id; every seventh id has its label moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
