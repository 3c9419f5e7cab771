"""Suffix-array dedup over bytes: which 400-byte strings start more than once anywhere.

All suffixes of all texts with their first 400 bytes would be 400 times the input, so they travel packed and only
where a repeat is possible:

1. The first and the last 200 bytes of a window have a minimiser each: the least hash among their 64-byte grams, the
   leftmost if several are equal. A window can only repeat if both hashes are found more than once. Hashes are
   counted first; text moves for documents that share some.
2. Consecutive windows that pass, and have the same 64-byte gram as the minimiser of the whole window, travel as one
   string, with the place of that gram (the anchor). Equal windows have equal anchors at equal distance. Equal
   strings are one row with a count: if it is over 1, all their windows repeat.
3. The strings are range-partitioned by the leading bytes at their anchor, with splitters that Spark samples. Within a
   bucket the suffixes of one anchor are sorted by multikey quicksort, eight bytes to a character: three-way
   partitions of all segments level by level, where a suffix that stands alone drops out. Those still together after 400
   bytes are equal, and every one of them repeats.
4. Equal anchors lie in one bucket, so nothing is lost at a boundary. An anchor with over ``CROWD`` strings is split by
   distance: its strings are cut into ``RANGES`` ranges of it, and all windows of a range hold the same bytes around the anchor,
   some 358 of 400. Range and bytes are the new key; a key that one string has is dropped after counting, the others are sorted as
   in 3. Only a key with over ``CROWD`` strings again, which differ in their last bytes alone, is compared across buckets,
   by 128-bit digests of its windows, grouped with map-side counts.

Nulls: a null text is empty, a null id comes before others; rows equal in id and text are one document, whose
repeats are judged as one, and each row gets its result. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import Scratch, file_limit, gather_key, row_key
from tidemark.llm.learn import give_back
from tidemark.llm.substring import COUNTED, counted, pair_keys, shared_keys, shared_minimisers

WINDOW = 400
HALF = 200
GRAM = 64
CROWD = 1000  # strings of one anchor, or of one range around it, that one task sorts: some 500 KB
RANGES = 8  # of the distance between a window's start and its anchor
LEVELS = WINDOW // 8
_PIECE = 1 << 20  # bytes of text worked through at a time: some twenty arrays of eight times as much
_SEGMENT = 1 << 18
_BATCH_WINDOWS = 200_000
_LOW = np.uint64((1 << 24) - 1)
_TABLE = W.mix64(np.arange(256, dtype=np.uint64) + np.uint64(1 << 20))


def minima(data: np.ndarray, width: int, m: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the minimiser gram of each ``width`` consecutive bytes."""
    count = len(data) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places, hashes, w = [], [], width - m + 1
    for start in range(0, count, _SEGMENT):
        n = min(_SEGMENT, count - start)
        grams = W.rolling(_TABLE[data[start : start + n + width - 1]], m)
        # order by 40 bits of the hash, then from the left
        keys = ((grams * np.uint64(0x9E3779B97F4A7C15)) & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        blocks = -(-len(keys) // w)
        padded = np.full(blocks * w, np.uint64(2**64 - 1))
        padded[: len(keys)] = keys
        grid = padded.reshape(blocks, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = (np.minimum(behind[:n], ahead[w - 1 : w - 1 + n]) & _LOW).astype(np.int64)
        places.append(least + start)
        change = np.concatenate([np.ones(1, bool), least[1:] != least[:-1]])
        heads = np.flatnonzero(change)
        own = W.mix64(grams[least[heads]]).view(np.int64)
        hashes.append(np.repeat(own, np.diff(np.append(heads, n))))
    return np.concatenate(places), np.concatenate(hashes)


def half_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first byte in all texts, windows, minimiser) of the runs of half windows, in texts with a whole one."""
    counts = np.where(np.diff(offsets) >= WINDOW, np.diff(offsets) - HALF + 1, 0)
    starts = W.ragged(offsets[:-1], counts)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none, none, none
    least, hashes = minima(data, HALF)
    least, hashes = least[starts], hashes[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(new)
    first = starts[heads]
    return np.searchsorted(offsets, first, "right") - 1, first, np.diff(np.append(heads, len(starts))), hashes[heads]


def minimisers(docs: DataFrame) -> DataFrame:
    """(mini, id, times) of the runs of half windows of rows (id, text): one row per document and minimiser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, limit=_PIECE):
            document, _, _, mini = half_runs(*W.raw_bytes(W.text_column(piece)))
            yield counted(document, mini, piece.column("id"))
        give_back()

    return docs.mapInArrow(run, COUNTED)


def settle_untouched(joined: DataFrame) -> DataFrame:
    """Rows that share no hash get their result, the others keep text and shared runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            texts = W.text_column(piece).cast(pa.binary())
            is_open = piece.column("shared").is_valid().to_pylist()
            digests = [None if o else sha256(t.as_buffer()).hexdigest() for t, o in zip(texts, is_open, strict=True)]
            sizes = [len(t.as_buffer()) for t in texts]
            kept = pa.array([t.as_py() if o else None for t, o in zip(texts, is_open, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    piece.column("h"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                    kept.cast(pa.string()),
                    piece.column("shared"),
                ],
                ["id", "h", "n_bytes", "sha", "text", "shared"],
            )

    return joined.mapInArrow(run, "id long, h long, n_bytes long, sha string, text string, shared array<long>")


def possible(data: np.ndarray, offsets: np.ndarray, piece: pa.RecordBatch) -> np.ndarray:
    """Whether both halves of the window that starts at each byte have a minimiser that their document shares."""
    document, first, n, mini = half_runs(data, offsets)
    keep = np.isin(pair_keys(document, mini), shared_keys(piece))
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, first[keep], 1)
    np.add.at(edges, first[keep] + n[keep], -1)
    shared = np.cumsum(edges)[:-1] > 0
    out = np.zeros(len(data), bool)
    n = max(0, len(data) - HALF)
    out[:n] = shared[:n] & shared[HALF:]
    return out


def strings(touched: DataFrame) -> DataFrame:
    """(string, at, id, h, pos) of rows (id, h, text, shared): ``at`` is the anchor's place in the string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, limit=_PIECE):
            data, offsets = W.raw_bytes(W.text_column(piece))
            least, _ = minima(data, WINDOW)
            out: list[tuple] = []
            ids, hashes = piece.column("id").to_pylist(), piece.column("h").to_pylist()
            candidate = possible(data, offsets, piece)
            for i in range(piece.num_rows):
                a, size = int(offsets[i]), int(offsets[i + 1] - offsets[i])
                here = np.flatnonzero(candidate[a : a + max(0, size - WINDOW + 1)])
                if not len(here):
                    continue
                anchor = least[a + here]
                new = np.ones(len(here), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (here[1:] != here[:-1] + 1)
                heads = np.flatnonzero(new)
                for first, n, at in zip(
                    here[heads].tolist(), np.diff(np.append(heads, len(here))).tolist(), anchor[heads].tolist(), strict=True
                ):
                    string = data[a + first : a + first + n + WINDOW - 1].tobytes()
                    out.append((string, at - a - first, ids[i], hashes[i], first))
            if out:
                kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["string", "at", "id", "h", "pos"],
                )
        give_back()

    return touched.mapInArrow(run, "string binary, at int, id long, h long, pos long")


def equal_windows(texts: list[bytes], anchors: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window of each text in the result, whether each window is equal to another one of its owner).

    Equal windows have their anchor at the same distance, so a large batch is worked through by distance.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    base, many = np.cumsum(sizes) - sizes, sizes - WINDOW + 1
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(many)])
    data = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
    equal = np.zeros(int(ends[-1]), bool)
    rounds = max(1, -(-len(equal) // _BATCH_WINDOWS))
    for k in range(rounds):
        low, high = k * WINDOW // rounds, (k + 1) * WINDOW // rounds
        if low == high:
            continue
        first = np.clip(anchors - high + 1, 0, many)
        count = np.clip(anchors - low + 1, 0, many) - first
        starts = W.ragged(base + first, count)
        key = np.repeat(owners, count) * WINDOW + np.repeat(anchors + base, count) - starts
        equal[W.ragged(ends[:-1] + first, count)] = _equal_suffixes(data, starts, key)
    return ends, equal


def _equal_suffixes(data: np.ndarray, starts: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which of the 400-byte strings at ``starts`` are equal to another one of their key.

    Multikey quicksort: segments of suffixes that agree so far are split by their next eight bytes.
    """
    chars = np.ndarray(len(data) - 7, np.uint64, buffer=data, strides=(1,))
    index = np.argsort(key, kind="stable")
    ordered = key[index]
    index, head = _segments(index, np.concatenate([np.ones(min(1, len(index)), bool), ordered[1:] != ordered[:-1]]))
    for level in range(LEVELS):
        if not len(index):
            break
        char = chars[starts[index] + 8 * level]
        differs = char != char[head]
        if not differs.any():
            continue
        split = np.zeros(len(index), bool)
        split[head[differs]] = True
        moved = np.flatnonzero(split[head])
        order = moved[np.lexsort((char[moved], head[moved]))]
        index[moved], char[moved] = index[order], char[order]
        new = head == np.arange(len(index))
        new[1:] |= char[1:] != char[:-1]
        index, head = _segments(index, new)
    equal = np.zeros(len(starts), bool)
    equal[index] = True
    return equal


def _segments(index: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of segments of two and more, and where each one's segment begins."""
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(index)))
    keep = np.repeat(sizes > 1, sizes)
    sizes = sizes[sizes > 1]
    return index[keep], np.repeat(np.cumsum(sizes) - sizes, sizes)


INTERVAL = "id long, h long, start long, length long"


def _intervals(ids: list, hashes: list, starts: list[np.ndarray]) -> pa.RecordBatch:
    """Runs of consecutive window starts of each text, as covered ranges."""
    rows = []
    for i, h, own in zip(ids, hashes, starts, strict=True):
        new = np.concatenate([np.ones(1, bool), own[1:] != own[:-1] + 1])
        heads = np.flatnonzero(new)
        for a, n in zip(own[heads].tolist(), np.diff(np.append(heads, len(own))).tolist(), strict=True):
            rows.append((i, h, a, n + WINDOW - 1))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "h", "start", "length"])


def repeats_in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered ranges of the strings that occur once; rows come sorted by leading bytes."""
    held: list[pa.RecordBatch] = []
    size = 0

    def out() -> pa.RecordBatch:
        owners = np.repeat(np.arange(len(held)), [r.num_rows for r in held])
        rows = pa.concat_batches(held)
        ends, equal = equal_windows(rows.column("string").to_pylist(), rows.column("at").to_numpy().astype(np.int64), owners)
        once, pos = rows.column("times").to_numpy() == 1, rows.column("pos").to_numpy()
        ids, hashes, found = rows.column("id").to_pylist(), rows.column("h").to_pylist(), []
        hit = np.flatnonzero(once & (W.sums(equal, ends) > 0))
        for i in hit:
            found.append(np.flatnonzero(equal[ends[i] : ends[i + 1]]) + pos[i])
        held.clear()
        return _intervals([ids[i] for i in hit], [hashes[i] for i in hit], found)

    for run in W.runs(batches, "lead"):
        if run.num_rows < 2:
            continue
        held.append(run)
        size += sum(len(x) - WINDOW + 1 for x in run.column("string").to_pylist())
        if size >= _BATCH_WINDOWS:
            yield out()
            size = 0
    if held:
        yield out()


def by_distance(crowded: DataFrame) -> DataFrame:
    """Strings of crowded anchors, cut by the distance of their windows to the anchor; ``lead`` is the range and what its windows share."""
    edges = [k * (WINDOW - GRAM + 1) // RANGES for k in range(RANGES + 1)]
    ranges = []
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        first = F.greatest(F.lit(0), F.col("at") - (high - 1))
        last = F.least(F.octet_length("string") - WINDOW, F.col("at") - low)
        ranges.append(
            F.struct(
                F.lit(bytes([k])).alias("k"), first.alias("first"), (last - first + WINDOW).alias("size"),
                (F.col("at") - low).alias("common"), F.lit(WINDOW - (high - 1) + low).alias("width"),
            )
        )
    cut = crowded.select("*", F.explode(F.array(*ranges)).alias("r")).filter(F.col("r.size") >= WINDOW)
    return cut.select(
        F.concat("r.k", F.expr("substring(string, r.common + 1, r.width)")).alias("lead"),
        F.expr("substring(string, r.first + 1, r.size)").alias("string"),
        (F.col("at") - F.col("r.first")).alias("at"), "id", "h", (F.col("pos") + F.col("r.first")).alias("pos"), "times",
    )


def repeats_in_crowds(crowded: DataFrame, scratch: Scratch, parts: int) -> DataFrame:
    """The same for crowded anchors."""
    cut = scratch.table(by_distance(crowded), "cut")
    place = F.struct("id", "h", "pos")
    found = cut.groupBy("lead", "string").agg(F.min(place).alias("first"), F.first("at").alias("at"), F.sum("times").alias("times"))
    found = found.select(F.xxhash64("lead").alias("part"), "lead", "string", "at", "first.id", "first.h", "first.pos", "times")
    found = scratch.table(found, "cut-strings")
    sizes = found.groupBy("part").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    sizes = scratch.table(sizes.select("part", (F.col("many") > CROWD).alias("crowded")), "cut-parts")
    shared = found.join(sizes, "part")
    calm = shared.filter(~F.col("crowded")).repartitionByRange(parts, "lead").sortWithinPartitions("lead")
    gone = calm.select("lead", "string", "at", "id", "h", "pos", "times").mapInArrow(repeats_in_buckets, INTERVAL)
    gone = gone.unionByName(repeats_by_digest(shared.filter("crowded")))
    # what several strings have in common repeats at all its places
    once = found.filter("times = 1").select("id", "h", "pos")
    twice = cut.filter("times = 1").join(once, ["id", "h", "pos"], "left_anti")
    length = F.octet_length("string").cast("long").alias("length")
    return gone.unionByName(twice.select("id", "h", F.col("pos").alias("start"), length))


def repeats_by_digest(crowded: DataFrame) -> DataFrame:
    """The same by digests of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, who, step = [], [], []
            for i, string in enumerate(batch.column("string").to_pylist()):
                n = len(string) - WINDOW + 1
                digests += [blake2b(string[j : j + WINDOW], digest_size=16).digest() for j in range(n)]
                who += [i] * n
                step += range(n)
            at = pa.array(who, pa.int64())
            start = np.asarray(batch.column("pos").take(at)) + np.array(step, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), *(batch.column(c).take(at) for c in ("id", "h")), pa.array(start), batch.column("times").take(at)],
                ["digest", "id", "h", "start", "times"],
            )

    cut = crowded.select("string", "id", "h", "pos", "times")
    cut = cut.mapInArrow(run, "digest binary, id long, h long, start long, times long")
    again = cut.groupBy("digest").agg(F.count(F.lit(1)).alias("many")).filter("many > 1").select("digest")
    hit = cut.filter("times = 1").join(again, "digest")
    return hit.select("id", "h", "start", F.lit(WINDOW).cast("long").alias("length"))


def settle_touched(joined: DataFrame) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, sha) of rows (id, text, n_bytes, gone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            data, offsets = W.raw_bytes(W.text_column(piece))
            removed, spans, digests = [], [], []
            for i in range(piece.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                gone = piece.column("gone")[i].values
                if gone is None or not len(gone):
                    removed.append(0)
                    spans.append(0)
                    digests.append(sha256(own.tobytes()).hexdigest())
                    continue
                edges = np.zeros(len(own) + 1, np.int64)
                start = gone.field("start").to_numpy()
                np.add.at(edges, start, 1)
                np.add.at(edges, start + gone.field("length").to_numpy(), -1)
                out = np.cumsum(edges)[:-1] > 0
                removed.append(int(out.sum()))
                spans.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
                digests.append(sha256(own[~out].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                ["id", "n_bytes", "n_removed", "n_spans", "sha"],
            )

    return joined.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, sha string")


def dedup(docs: DataFrame) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, sha) of every row of docs (doc_id, text); see the module's text."""
    spark = docs.sparkSession
    files = file_limit(docs)
    scratch = Scratch(spark, "suffixes", files)
    rows = docs.select(row_key().alias("k"), "text").select("k.id", "k.h", "text")
    # documents that clash in this key see each other's minimisers, and keep those that are their own
    rows = rows.withColumn("gather", gather_key())
    shared = shared_minimisers(minimisers(rows.select(F.col("gather").alias("id"), "text"))).withColumnRenamed("id", "gather")
    joined = scratch.table(settle_untouched(rows.join(shared, "gather", "left")), "joined")
    touched = joined.filter("shared is not null")

    packed = strings(touched.select("id", "h", "text", "shared").dropDuplicates(["id", "h"]))
    packed = scratch.table(packed, "packed")
    place = F.struct("id", "h", "pos")
    found = packed.groupBy("string").agg(F.min(place).alias("first"), F.first("at").alias("at"), F.count(F.lit(1)).alias("times"))
    lead = F.expr(f"substring(string, at + 1, {GRAM})")
    found = scratch.table(found.select(lead.alias("lead"), "string", "at", "first.id", "first.h", "first.pos", "times"), "strings")
    crowds = found.groupBy("lead").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > CROWD).select("lead")
    crowds = scratch.table(crowds, "crowds")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    calm = found.join(crowds, "lead", "left_anti").repartitionByRange(parts, "lead").sortWithinPartitions("lead")
    gone = calm.mapInArrow(repeats_in_buckets, INTERVAL)
    gone = gone.unionByName(repeats_in_crowds(found.join(crowds, "lead", "left_semi"), scratch, parts))
    # strings that occur twice and more are repeats at all their places
    every = packed.select("id", "h", "pos", (F.octet_length("string")).cast("long").alias("length"))
    once = found.filter("times = 1").select("id", "h", "pos")
    twice = every.join(once, ["id", "h", "pos"], "left_anti")
    gone = gone.unionByName(twice.select("id", "h", F.col("pos").alias("start"), "length"))
    gone = gone.groupBy("id", "h").agg(F.collect_list(F.struct("start", "length")).alias("gone"))
    done = settle_touched(touched.select("id", "h", "text", "n_bytes").join(gone, ["id", "h"], "left")).coalesce(files)
    zero = F.lit(0).cast("long")
    plain = joined.filter("shared is null").select("id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "sha")
    return plain.unionByName(done)


def op6(spark, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes, removed runs and the hash of what is kept, of all documents."""
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    doc_id = F.when(F.col("id") != F.lit(-(2**63)), F.col("id"))
    return out.select(doc_id.alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("sha").alias("kept_sha256"))
