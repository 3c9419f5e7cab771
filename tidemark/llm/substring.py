"""Substring dedup over words by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of a document. Its minimiser is the least hash among its ``GRAM``-word grams, the
leftmost if several are equal. Consecutive windows with the same minimiser gram form a super-k-mer, which is one
string; equal windows have equal minimisers, so they meet in one bucket.

1. Only minimisers that several super-k-mers share can hold a repeated window: they are counted first, by hash, so
   that text moves only for documents that have some.
2. Equal strings of super-k-mers are one row, with the earliest place. All later places of that string are repeats.
3. The distinct strings go to the buckets of their minimisers. A bucket cuts them into windows and sorts these; of
   equal ones all but the earliest are repeats. Windows are compared as text.
4. A crowded bucket (over ``CROWD`` strings) is split by the distance of a window to its minimiser: strings are cut into ``RANGES``
   ranges of it, and all windows of a range share some 14 words around the minimiser. Range and words are the new bucket; one with a
   single string is dropped after counting, the others are sorted as in 3. Only the windows of a bucket that is crowded
   again are grouped as rows of their own.
5. Words covered by repeats go. A document's intervals are joined to its text by id.

Windows are judged on the input. Of two documents with the same id, that with the lower text hash comes first; rows
equal in id and text are one document and get the same result, once per row. A null id comes before all others. A
null text has no words. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import Scratch, file_limit, gather_key, row_key

WINDOW = 20
GRAM = 7
CROWD = 2000  # strings of one bucket that one task sorts: some 400 KB
RANGES = 2  # of the distance between a window's start and its minimiser
_PIECE = 3 << 20


def super_kmers(words: W.Words, k: int = WINDOW, m: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word within it, windows, minimiser) of each super-k-mer."""
    starts = W.window_starts(words.offsets, k)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none, none, none
    grams = W.mix64(W.rolling(words.hashes()[words.ids], m))
    least = W.sliding_min(grams, k - m + 1)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(starts)))
    first = starts[heads]
    document = np.searchsorted(words.offsets, first, "right") - 1
    return document, first - words.offsets[document], counts, grams[least[heads]].view(np.int64)


def minimisers(docs: DataFrame) -> DataFrame:
    """(mini, id, times) of the super-k-mers of rows (id, text): one row per document and minimiser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, limit=_PIECE):
            document, _, _, mini = super_kmers(W.split(W.text_column(piece)))
            yield counted(document, mini, piece.column("id"))

    return docs.mapInArrow(run, COUNTED)


COUNTED = "mini long, id long, times int"


def counted(document: np.ndarray, mini: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
    """A row per document and minimiser, with how often it occurs there: a text of repeats sends few rows."""
    order = np.lexsort((mini, document))
    document, mini = document[order], mini[order]
    new = np.ones(len(mini), bool)
    new[1:] = (mini[1:] != mini[:-1]) | (document[1:] != document[:-1])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(mini))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(mini[heads]), ids.take(pa.array(document[heads])), pa.array(times)], ["mini", "id", "times"]
    )


def shared_minimisers(spots: DataFrame) -> DataFrame:
    """(id, shared): per id the minimisers that occur more than once anywhere."""
    often = spots.groupBy("mini").agg(F.sum("times").alias("all")).filter("all > 1").select("mini")
    return spots.select("mini", "id").join(often, "mini").groupBy("id").agg(F.collect_set("mini").alias("shared"))


def _digest(words: list[bytes]) -> str:
    return sha256(b" ".join(words)).hexdigest()


def settle_untouched(joined: DataFrame) -> DataFrame:
    """Rows without shared minimisers get their result, the others keep their text: (id, h, n_words, sha, text, shared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            texts = W.text_column(piece).cast(pa.binary())
            open_rows = piece.column("shared").is_valid().to_numpy(zero_copy_only=False)
            counts, digests = [], []
            for text, is_open in zip(texts, open_rows, strict=True):
                own = text.as_py().split()
                counts.append(len(own))
                digests.append(None if is_open else _digest(own))
            kept = pa.array([t.as_py() if o else None for t, o in zip(texts, open_rows, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    piece.column("h"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.string()),
                    kept.cast(pa.string()),
                    piece.column("shared"),
                ],
                ["id", "h", "n_words", "sha", "text", "shared"],
            )

    return joined.mapInArrow(run, "id long, h long, n_words long, sha string, text string, shared array<long>")


def _shared_super_kmers(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The super-k-mers of a piece whose minimisers are in their document's ``shared``."""
    document, pos, n, mini = super_kmers(W.split(W.text_column(piece)))
    keep = np.isin(pair_keys(document, mini), shared_keys(piece))
    return document[keep], pos[keep], n[keep], mini[keep]


def pair_keys(document: np.ndarray, mini: np.ndarray) -> np.ndarray:
    """A number for each pair; pairs that clash by chance only make a candidate more."""
    return W.mix64(mini.view(np.uint64) ^ W.mix64(document))


def shared_keys(piece: pa.RecordBatch) -> np.ndarray:
    """The pairs that the documents of a piece have in ``shared``."""
    lists = piece.column("shared")
    owner = np.repeat(np.arange(piece.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return pair_keys(owner, lists.flatten().to_numpy(zero_copy_only=False))


def strings(touched: DataFrame, k: int = WINDOW) -> DataFrame:
    """(mini, string, id, h, pos) of the shared super-k-mers of rows (id, h, text, shared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, limit=_PIECE):
            document, pos, n, mini = _shared_super_kmers(piece)
            texts, string = W.text_column(piece).cast(pa.binary()), []
            heads = np.searchsorted(document, np.arange(piece.num_rows + 1)).tolist()
            for i in range(piece.num_rows):
                if heads[i] == heads[i + 1]:
                    continue
                own = texts[i].as_py().split()
                plain = b" ".join(own)
                ends = [0, *np.cumsum([len(w) + 1 for w in own]).tolist()]
                here = slice(heads[i], heads[i + 1])
                string += [plain[ends[p] : ends[p + m + k - 1] - 1] for p, m in zip(pos[here].tolist(), n[here].tolist(), strict=True)]
            who = pa.array(document)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mini),
                    pa.array(string, pa.binary()),
                    piece.column("id").take(who),
                    piece.column("h").take(who),
                    pa.array(pos.astype(np.int32)),
                ],
                ["mini", "string", "id", "h", "pos"],
            )

    return touched.mapInArrow(run, "mini long, string binary, id long, h long, pos int")


def shared_places(touched: DataFrame) -> DataFrame:
    """(id, h, pos, n) of the same super-k-mers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, limit=_PIECE):
            document, pos, n, _ = _shared_super_kmers(piece)
            who = pa.array(document)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id").take(who), piece.column("h").take(who), pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32))],
                ["id", "h", "pos", "n"],
            )

    return touched.mapInArrow(run, "id long, h long, pos int, n int")


def windows_of(string: bytes, k: int = WINDOW) -> list[bytes]:
    own = string.split(b" ")
    ends = np.cumsum([len(w) + 1 for w in own]).tolist()
    return [string[(ends[j - 1] if j else 0) : ends[j + k - 1] - 1] for j in range(len(own) - k + 1)]


INTERVAL = "id long, h long, start int, length int"


def repeats_in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of repeated windows at the earliest places of strings; rows come sorted by minimiser."""
    found: list[tuple[int, int, int, int]] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*found, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["id", "h", "start", "length"]
        )
        found.clear()
        return batch

    for run in W.runs(batches, "mini"):
        if run.num_rows < 2:
            continue
        rows = zip(*(run.column(c).to_pylist() for c in ("string", "id", "h", "pos")), strict=True)
        cut = [(w, i, h, pos + j) for string, i, h, pos in rows for j, w in enumerate(windows_of(string))]
        cut.sort()
        later = sorted(b[1:] for a, b in zip(cut, cut[1:], strict=False) if a[0] == b[0])
        for i, h, start in later:
            if found and found[-1][:2] == (i, h) and found[-1][2] + found[-1][3] - WINDOW + 1 == start:
                found[-1] = (i, h, found[-1][2], found[-1][3] + 1)
            else:
                found.append((i, h, start, WINDOW))
        if len(found) > 20_000:
            yield out()
    if found:
        yield out()


def by_distance(crowded: DataFrame, k: int = WINDOW, m: int = GRAM) -> DataFrame:
    """(lead, string, id, h, pos, n): strings of crowded buckets, cut by the distance of their windows to the minimiser.

    ``lead`` is the range and the words that all its windows share, ``n`` the number of words.
    """
    edges = [r * (k - m + 1) // RANGES for r in range(RANGES + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, "string", _PIECE):
            words = W.split(W.text_column(piece, "string"))
            heads = words.offsets[:-1]
            grams = W.mix64(W.rolling(words.hashes()[words.ids], m))
            places = (W.sliding_min(grams, k - m + 1)[heads] - heads).tolist()
            owner, made = [], []
            for i, (string, at, size) in enumerate(zip(piece.column("string").to_pylist(), places, words.counts.tolist(), strict=True)):
                ends = [0]
                for w in string.split(b" "):
                    ends.append(ends[-1] + len(w) + 1)
                for r, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    first, last = max(0, at - high + 1), min(size - k, at - low)
                    if first <= last:
                        common = string[ends[at - low] : ends[at - high + 1 + k] - 1]
                        made.append((bytes([r]) + common, string[ends[first] : ends[last + k] - 1], first, last - first + k))
                        owner.append(i)
            lead, own, first, n = zip(*made, strict=True) if made else ((), (), (), ())
            who = pa.array(owner, pa.int64())
            pos = np.asarray(piece.column("pos").take(who)) + np.array(first, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lead, pa.binary()), pa.array(own, pa.binary()), piece.column("id").take(who), piece.column("h").take(who),
                    pa.array(pos.astype(np.int32)), pa.array(n, pa.int32()),
                ],
                ["lead", "string", "id", "h", "pos", "n"],
            )

    cut = crowded.select("string", "id", "h", "pos")
    return cut.mapInArrow(run, "lead binary, string binary, id long, h long, pos int, n int")


def repeats_in_crowds(crowded: DataFrame, scratch: Scratch, parts: int) -> DataFrame:
    """The same for crowded buckets."""
    cut = scratch.table(by_distance(crowded), "cut")
    found = cut.groupBy("lead", "string").agg(F.min(F.struct("id", "h", "pos")).alias("first"))
    found = scratch.table(found.select(F.xxhash64("lead").alias("mini"), "string", "first.id", "first.h", "first.pos"), "cut-strings")
    sizes = found.groupBy("mini").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    sizes = scratch.table(sizes.select("mini", (F.col("many") > CROWD).alias("crowded")), "cut-sizes")
    shared = found.join(sizes, "mini")
    calm = shared.filter(~F.col("crowded")).drop("crowded").repartition(parts, "mini").sortWithinPartitions("mini")
    gone = calm.mapInArrow(repeats_in_buckets, INTERVAL).unionByName(repeats_by_window(shared.filter("crowded")))
    later = cut.join(found.select("id", "h", "pos"), ["id", "h", "pos"], "left_anti")
    return gone.unionByName(later.select("id", "h", F.col("pos").alias("start"), F.col("n").alias("length")))


def repeats_by_window(crowded: DataFrame) -> DataFrame:
    """The same with a row per window: grouping combines before it shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [windows_of(s) for s in batch.column("string").to_pylist()]
            who = pa.array(np.repeat(np.arange(len(cut)), [len(x) for x in cut]))
            step = np.concatenate([np.arange(len(x), dtype=np.int32) for x in cut]) if cut else np.zeros(0, np.int32)
            at = np.asarray(batch.column("pos").take(who)) + step
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for x in cut for w in x], pa.binary()), batch.column("id").take(who), batch.column("h").take(who), pa.array(at)],
                ["win", "id", "h", "start"],
            )

    cut = crowded.select("string", "id", "h", "pos").mapInArrow(run, "win binary, id long, h long, start int")
    place = F.struct("id", "h", "start")
    earliest = cut.groupBy("win").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    later = cut.join(earliest.select("win", "first"), "win").filter(place != F.col("first"))
    return later.select("id", "h", "start", F.lit(WINDOW).alias("length"))


def settle_touched(joined: DataFrame) -> DataFrame:
    """(id, h, n_words, n_removed, sha, kept) of rows (id, h, text, n_words, gone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            texts, removed, digests = W.text_column(piece).cast(pa.binary()), [], []
            for i in range(piece.num_rows):
                own = texts[i].as_py().split()
                edges = np.zeros(len(own) + 1, np.int64)
                gone = piece.column("gone")[i].values
                if gone is not None and len(gone):
                    start = gone.field("start").to_numpy()
                    np.add.at(edges, start, 1)
                    np.add.at(edges, start + gone.field("length").to_numpy(), -1)
                keep = np.cumsum(edges)[:-1] == 0
                removed.append(len(own) - int(keep.sum()))
                digests.append(_digest([own[j] for j in np.flatnonzero(keep)]))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("n_words"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["id", "n_words", "n_removed", "sha"],
            )

    return joined.mapInArrow(run, "id long, n_words long, n_removed long, sha string")


def dedup(docs: DataFrame) -> DataFrame:
    """(id, n_words, n_removed, sha) of every row of docs (doc_id, text); see the module's text."""
    files = file_limit(docs)
    scratch = Scratch(docs.sparkSession, "substring", files)
    rows = docs.select(row_key().alias("k"), "text").select("k.id", "k.h", "text")
    # documents that clash in this key see each other's minimisers, and keep those that are their own
    rows = rows.withColumn("gather", gather_key())
    shared = shared_minimisers(minimisers(rows.select(F.col("gather").alias("id"), "text"))).withColumnRenamed("id", "gather")
    joined = scratch.table(settle_untouched(rows.join(shared, "gather", "left")), "joined")
    touched = joined.filter("shared is not null")

    place = F.struct("id", "h", "pos")
    found = strings(touched.select("id", "h", "text", "shared"))
    found = found.groupBy("string").agg(F.min(place).alias("first"), F.first("mini").alias("mini"))
    found = scratch.table(found.select("mini", "string", "first.id", "first.h", "first.pos"), "strings")
    crowds = found.groupBy("mini").agg(F.count(F.lit(1)).alias("many"))
    crowds = scratch.table(crowds.filter(F.col("many") > CROWD).select("mini"), "crowds")
    calm = found.join(crowds, "mini", "left_anti")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    calm = calm.repartition(parts, "mini").sortWithinPartitions("mini")
    gone = calm.mapInArrow(repeats_in_buckets, INTERVAL)
    gone = gone.unionByName(repeats_in_crowds(found.join(crowds, "mini", "left_semi"), scratch, parts))
    each = shared_places(touched.select("id", "h", "text", "shared"))
    later = each.join(found.select("id", "h", "pos"), ["id", "h", "pos"], "left_anti")
    gone = gone.unionByName(later.select("id", "h", F.col("pos").alias("start"), (F.col("n") + WINDOW - 1).alias("length")))
    gone = gone.groupBy("id", "h").agg(F.collect_list(F.struct("start", "length")).alias("gone"))
    done = settle_touched(touched.select("id", "h", "text", "n_words").join(gone, ["id", "h"], "left")).coalesce(files)
    plain = joined.filter("shared is null").select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), "sha")
    return plain.unionByName(done)


def op1(spark, sf_dir: str) -> DataFrame:
    """Words, removed words and the hash of what is kept, of all documents."""
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    doc_id = F.when(F.col("id") != F.lit(-(2**63)), F.col("id"))
    return out.select(doc_id.alias("doc_id"), "n_words", "n_removed", F.col("sha").alias("kept_sha256"))
