"""MinHash near-dedup with an LSH forest.

A document is the set of its distinct word shingles. Equal sets are one class, found by digest. Each class's
MinHash signature is sorted in ``TREES`` orders; classes that share the first ``DEPTH`` values of an order form a
region of that tree. Candidates come from the regions:

* in a region of up to ``CROWD`` classes, a spanning forest of the pairs whose signatures agree well enough,
  the best agreement first;
* a crowded region is ordered by further values and then by the whole signature, so its depth adapts to how
  crowded it is: classes are paired with their next ``REACH`` neighbours in that order, which have the longest common
  prefixes, and with the region's first class. It is dealt out by range, so it may be spread over many tasks.

Candidates are confirmed on full sets. If every candidate of a small region is a link, all its similar classes are
connected already; so they are in a crowded one whose classes are one component. In all other regions all pairs of the region that agree well enough and are not connected yet are
confirmed as well, less those that cannot be links: the bits in which two sets' bitmaps differ are a lower bound
of the members in which the sets differ. Such a region is dealt out in blocks of about ``BLOCK`` members by parts of as
many, so no task holds a whole region. A pair at the limit of 0.85 shares no region with a chance of 1e-5.

Nulls: a null text has no words; documents without words are linked with nothing. A null id sorts first.
Rows equal in id and text are one document. Fewer words than a shingle make one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.components import components
from tidemark.llm.frames import Scratch, row_key, unused

SHINGLE = 5
PERCENT = 85
HASHES = 64
TREES = 16
DEPTH = 4
DEEP = 8
CROWD = 256
REACH = 4
BLOCK = 4096  # expected members on a side of what one task compares at a time
AGREE = 42  # of HASHES; at a similarity of 0.85 fewer agree with a chance of 1e-5
SKETCH_BYTES = HASHES // 2
BITMAP = 4096
_PIECE = 2 << 20

_RNG = np.random.default_rng(85)
_A = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
# the values each tree sorts by: its own DEPTH ones first, then others
_ORDERS = np.array(
    [
        np.concatenate([np.arange(t * DEPTH, (t + 1) * DEPTH), (t * DEPTH + DEPTH + np.arange(DEEP - DEPTH) * 7) % HASHES])
        for t in range(TREES)
    ]
)
KEY = "id long, h long"


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, A-Z lower-cased."""
    words = W.split(pc.ascii_lower(texts))
    values = words.hashes()[words.ids]
    counts = words.counts
    whole = W.rolling(values, k)
    out = []
    for i, (a, b) in enumerate(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True)):
        if b - a >= k:
            out.append(np.unique(whole[a : b - k + 1]))
        elif b > a:
            n = int(counts[i])
            out.append(W.mix64(W.rolling(values[a:b], n) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """[set, HASHES] least values; a set must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint32)
    for j in range(HASHES):
        out[:, j] = np.minimum.reduceat((flat * _A[j] + _B[j]) >> np.uint64(32), starts)
    return out


def sketch(signatures: np.ndarray) -> np.ndarray:
    """Four bits of each value, packed."""
    low = (signatures * np.uint32(0x9E3779B1)) >> np.uint32(28)
    return ((low[:, 0::2] << 4) | low[:, 1::2]).astype(np.uint8)


def signed(docs: DataFrame) -> DataFrame:
    """(id, h, n_shingles, digest, signature) of rows (id, h, text); the last two null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, limit=_PIECE):
            sets = shingle_sets(W.text_column(piece))
            full = [i for i, s in enumerate(sets) if len(s)]
            signatures: list[bytes | None] = [None] * len(sets)
            digests: list[bytes | None] = [None] * len(sets)
            if full:
                for i, row in zip(full, minhash([sets[i] for i in full]), strict=True):
                    signatures[i] = row.tobytes()
                    digests[i] = blake2b(sets[i].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    piece.column("h"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                ["id", "h", "n_shingles", "digest", "signature"],
            )

    return docs.mapInArrow(run, f"{KEY}, n_shingles long, digest binary, signature binary")


def forest(classes: DataFrame) -> DataFrame:
    """One row per class and tree: region (tree and first values), order (further values), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
            packed = pa.array([x.tobytes() for x in sketch(signatures)], pa.binary())
            for t in range(TREES):
                values = signatures[:, _ORDERS[t]].astype(">u4")
                region = [bytes([t]) + x.tobytes() for x in values[:, :DEPTH]]
                order = [x.tobytes() for x in values[:, DEPTH:]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(region, pa.binary()),
                        pa.array(order, pa.binary()),
                        packed,
                        batch.column("id"),
                        batch.column("h"),
                        batch.column("n_shingles"),
                    ],
                    ["region", "order", "sketch", "id", "h", "n"],
                )

    return classes.mapInArrow(run, f"region binary, order binary, sketch binary, {KEY}, n long")


_SAME = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)


def agreement(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """How many of the signature values agree, of one sketch with each of many."""
    return _SAME[one[None, :] ^ many].sum(axis=1, dtype=np.int64)


def similar(one: int, sketches: np.ndarray, sizes: np.ndarray, others: slice | np.ndarray) -> np.ndarray:
    """Agreement of a member with others, 0 where it or the sizes rule out a link."""
    same = agreement(sketches[one], sketches[others])
    n, m = sizes[one], sizes[others]
    return np.where((same >= AGREE) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)), same, 0)


def spanning(sketches: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest of the similar pairs of a small region."""
    n = len(sizes)
    if n == 2:
        return [(0, 1)] if similar(0, sketches, sizes, slice(1, 2))[0] else []
    best, link, out = np.full(n, -1, np.int64), np.full(n, -1), []
    waiting = np.ones(n, bool)
    while waiting.any():
        at = int(np.argmax(np.where(waiting, best, -2)))
        if best[at] > 0:
            out.append((int(link[at]), at))
        waiting[at] = False
        same = similar(at, sketches, sizes, slice(None))
        better = waiting & (same > best)
        best[better], link[better] = same[better], at
    return out


def neighbours(sketches: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Similar pairs of a crowded region: near ones in its order, and each member with the first."""
    out = []
    for i in range(len(sizes)):
        stop = min(len(sizes), i + 1 + REACH)
        out += [(i, i + 1 + j) for j in np.flatnonzero(similar(i, sketches, sizes, slice(i + 1, stop)))]
    out += [(0, int(j) + 1) for j in np.flatnonzero(similar(0, sketches, sizes, slice(1, None)))]
    return out


PAIRS = "region binary, a struct<id:long,h:long>, b struct<id:long,h:long>"


def _pair_batches(found: list[tuple], limit: int) -> Iterator[pa.RecordBatch]:
    if len(found) > limit:
        region, one, two = zip(*found, strict=True)
        kind = pa.struct([("id", pa.int64()), ("h", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(region, pa.binary()),
                *(pa.array([{"id": i, "h": h} for i, h in side], kind) for side in (one, two)),
            ],
            ["region", "a", "b"],
        )
        found.clear()


def _members(run: pa.RecordBatch) -> tuple[bytes, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    sketches = np.frombuffer(b"".join(run.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH_BYTES)
    keys = list(zip(run.column("id").to_pylist(), run.column("h").to_pylist(), strict=True))
    return run.column("region")[0].as_py(), sketches, run.column("n").to_numpy(), keys


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First candidates of each region; rows come sorted by region, order and sketch."""
    found: list[tuple] = []
    for run in W.runs(batches, "region"):
        if run.num_rows < 2:
            continue
        region, sketches, sizes, keys = _members(run)
        pairs = spanning(sketches, sizes) if len(keys) <= CROWD else neighbours(sketches, sizes)
        found += [(region, min(keys[i], keys[j]), max(keys[i], keys[j])) for i, j in pairs]
        yield from _pair_batches(found, 20_000)
    yield from _pair_batches(found, 0)


def bitmap(members: np.ndarray) -> bytes:
    """A bit for each value of the members' top bits that occurs."""
    bits = np.zeros(BITMAP, bool)
    bits[members >> np.uint64(64 - BITMAP.bit_length() + 1)] = True
    return np.packbits(bits).tobytes()


def may_link(bits: np.ndarray, sizes: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """Whether the bitmaps leave it open that two sets are similar enough; they never rule out a link."""
    apart = np.bitwise_count(bits[one] ^ bits[others]).sum(axis=1, dtype=np.int64)
    total = sizes[one] + sizes[others]
    # similarity is (total - d) / (total + d), with d members in one set only
    return 100 * (total - apart) >= PERCENT * (total + apart)


def blocks(left: DataFrame) -> DataFrame:
    """What to compare of regions (region, id, h, cid, ch, ...), in units of bounded size; ``region`` names the unit.

    Members outside a region's largest component are dealt into blocks, all its members into parts; a unit is a block
    (``one``) against a part (``two``). Where one unit takes the whole region, each member is one row of it. Regions of
    one component have no units.
    """
    about = left.groupBy("region", "cid", "ch").agg(F.count(F.lit(1)).alias("n"))
    about = about.groupBy("region").agg(F.sum("n").alias("_all"), F.max(F.struct("n", "cid", "ch")).alias("_most"))
    out = left.join(about.filter(F.col("_all") > F.col("_most.n")), "region")
    outside = (F.col("cid") != F.col("_most.cid")) | (F.col("ch") != F.col("_most.ch"))
    n_blocks = F.ceil((F.col("_all") - F.col("_most.n")) / F.lit(BLOCK)).cast("int")
    n_parts = F.ceil(F.col("_all") / F.lit(BLOCK)).cast("int")
    out = out.withColumns({"outside": outside, "_blocks": n_blocks, "_parts": n_parts})
    out = out.withColumns(
        {f"_{x}": F.pmod(F.xxhash64("id", "h", F.lit(x)), F.col(f"_{x}s")).cast("int") for x in ("block", "part")}
    )

    def unit(block: F.Column, part: F.Column, one: F.Column, two: F.Column) -> F.Column:
        return F.struct(block.alias("block"), part.alias("part"), one.alias("one"), two.alias("two"))

    own_block, own_part, yes, no = F.col("_block"), F.col("_part"), F.lit(True), F.lit(False)
    as_two = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1), lambda b: unit(b, own_part, F.col("outside") & (b == own_block), yes)
    )
    as_one = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda p: unit(own_block, p, yes, no))
    as_one = F.filter(as_one, lambda u: F.col("outside") & (u["part"] != own_part))
    out = out.withColumn("_unit", F.explode(F.concat(as_two, as_one)))
    name = F.concat("region", F.encode(F.concat_ws(":", "_unit.block", "_unit.part"), "utf-8"))
    return out.select(name.alias("region"), *[c for c in left.columns if c != "region"], "outside", "_unit.one", "_unit.two")


def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of each unit of ``blocks`` that may be links and whose members are not connected yet, as they are found.

    A pair of two members outside the largest component is in two units and taken from one.
    """
    found: list[tuple] = []
    for run in W.runs(batches, "region"):
        if run.num_rows < 2:
            continue
        region, sketches, sizes, keys = _members(run)
        bits = np.frombuffer(b"".join(run.column("bits").to_pylist()), np.uint8).reshape(-1, BITMAP // 8)
        parts = np.unique(
            [f"{i}:{h}" for i, h in zip(run.column("cid").to_pylist(), run.column("ch").to_pylist(), strict=True)],
            return_inverse=True,
        )[1]
        one, two, outside = (run.column(c).to_numpy(zero_copy_only=False) for c in ("one", "two", "outside"))
        place = np.empty(len(keys), np.int64)
        place[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
        part = np.flatnonzero(two)
        for i in np.flatnonzero(one):
            hit = similar(int(i), sketches, sizes, part)
            hit[(parts[part] == parts[i]) | (outside[part] & (place[part] < place[i]))] = 0
            others = part[np.flatnonzero(hit)]
            others = others[may_link(bits, sizes, int(i), others)]
            found += [(region, min(keys[i], keys[j]), max(keys[i], keys[j])) for j in others]
            yield from _pair_batches(found, 20_000)
    yield from _pair_batches(found, 0)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with whether their full sets are similar enough."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("key").alias(name), F.col("members").alias(f"set_{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                both = np.concatenate([np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(100 * shared >= PERCENT * (len(both) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(run, "a struct<id:long,h:long>, b struct<id:long,h:long>, linked boolean")


def set_table(rows: DataFrame) -> DataFrame:
    """(key, members, bits) of rows (id, h, text): the shingle sets as sorted 64-bit numbers, and their bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("id", pa.int64()), ("h", pa.int64())])
        for piece in W.pieces(batches, limit=_PIECE):
            sets = shingle_sets(W.text_column(piece))
            key = [{"id": i, "h": h} for i, h in zip(piece.column("id").to_pylist(), piece.column("h").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, kind), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(map(bitmap, sets), pa.binary())],
                ["key", "members", "bits"],
            )

    return rows.mapInArrow(run, "key struct<id:long,h:long>, members binary, bits binary")


def sets_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of the documents (id, h) wanted, each once.

    The join is dealt by key whatever the size of ``wanted``, which grows with the documents.
    """
    return set_table(rows.join(wanted.hint("merge"), ["id", "h"], "left_semi").dropDuplicates(["id", "h"]))


def _key() -> F.Column:
    return F.struct("id", "h")


def groups(docs: DataFrame) -> DataFrame:
    """(id, h, n_shingles, component struct<id, h>) of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    rows = docs.select(row_key().alias("k"), "text").select("k.id", "k.h", "text")
    signed_rows = scratch.table(signed(rows), "signed")
    classes = signed_rows.filter("digest is not null").groupBy("digest")
    classes = classes.agg(
        F.min(_key()).alias("rep"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")
    )
    classes = scratch.table(classes.select("digest", "rep.id", "rep.h", "signature", "n_shingles"), "classes")

    trees = forest(classes.select("id", "h", "n_shingles", "signature"))
    sizes = trees.groupBy("region").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = scratch.table(sizes, "regions")
    trees = trees.join(shared, "region")
    # a crowded region may be cut anywhere, a small one nowhere
    place = F.when(F.col("members") > CROWD, F.concat("region", "order", "sketch")).otherwise(F.col("region"))
    trees = scratch.table(trees.withColumn("place", place), "forest")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = trees.repartitionByRange(parts, "place").sortWithinPartitions("region", "order", "sketch", "id", "h")
    dealt = dealt.select("region", "sketch", "id", "h", "n")
    first = scratch.table(dealt.mapInArrow(candidates, PAIRS), "candidates")

    pairs = first.select("a", "b").distinct()
    # a member of a small region that is in no pair is similar to no one there; of a crowded one all may be
    named = first.select(F.explode(F.array("a", "b")).alias("k")).select("k.id", "k.h")
    crowded = trees.filter(F.col("members") > CROWD).select("id", "h")
    involved = named.unionByName(crowded).distinct()
    sets = scratch.table(sets_of(rows, involved), "sets")
    checked = scratch.table(confirmed(pairs, sets), "checked")
    links = checked.filter("linked").select("a", "b")

    open_regions = first.join(checked.filter("not linked"), ["a", "b"], "left_semi").select("region").distinct()
    # neighbours are not all similar classes of a crowded region; blocks() drops those of one component
    open_regions = open_regions.unionByName(shared.filter(F.col("members") > CROWD).select("region")).distinct()
    open_regions = scratch.table(open_regions, "open")
    if open_regions.take(1):
        so_far = components(links, scratch, "first").select(F.col("node.id").alias("id"), F.col("node.h").alias("h"), "component")
        left = trees.join(open_regions, "region", "left_semi").join(so_far, ["id", "h"], "left")
        part = F.coalesce(F.col("component"), _key())
        left = left.select("region", "sketch", "id", "h", "n", part["id"].alias("cid"), part["h"].alias("ch"))
        left = blocks(scratch.table(left, "left").join(sets.select("key.id", "key.h", "bits"), ["id", "h"]))
        left = left.repartition(parts, "region").sortWithinPartitions("region")
        more = left.mapInArrow(remaining, PAIRS).select("a", "b").distinct()
        more = more.join(checked, ["a", "b"], "left_anti")
        again = scratch.table(confirmed(more, sets), "again")
        links = scratch.table(links.unionByName(again.filter("linked").select("a", "b")), "links")
    found = components(links, scratch, "last")
    found = found.select(F.col("node.id").alias("id"), F.col("node.h").alias("h"), "component")
    named = classes.select("digest", "id", "h").join(found, ["id", "h"], "left")
    named = named.select("digest", F.coalesce("component", _key()).alias("component"))
    out = signed_rows.drop("signature").join(named, "digest", "left")
    return out.select("id", "h", "n_shingles", F.coalesce("component", _key()).alias("component"))


def op3(spark, sf_dir: str) -> DataFrame:
    """Set size, component and fate of all documents."""
    out = groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

    def known(c: str) -> F.Column:
        return F.when(F.col(c) != F.lit(-(2**63)), F.col(c))

    return out.select(
        known("id").alias("doc_id"),
        "n_shingles",
        known("component.id").alias("component_id"),
        (F.col("id") == F.col("component.id")).alias("kept"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, with its own columns; of equal rows one."""
    kept = groups(docs.select("doc_id", "text")).filter(F.struct("id", "h") == F.col("component")).select("id", "h").distinct()
    i, h = unused(docs, "row_id"), unused(docs, "row_hash")
    kept = kept.select(F.col("id").alias(i), F.col("h").alias(h))
    keyed = docs.withColumns({i: row_key()["id"], h: row_key()["h"]})
    return keyed.join(kept, [i, h], "left_semi").dropDuplicates([i, h]).select(*docs.columns)
