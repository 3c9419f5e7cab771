"""Whole texts as arrays: words, their hashes and windows, for use inside Arrow tasks.

A word is a run of characters other than space and U+0009 to U+000D. All arrays stay in numpy or
Arrow; a batch is worked through in pieces of bounded bytes, a longer document in a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 3 << 20


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as strings, null as empty."""
    column = batch.column(name)
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def pieces(
    batches: Iterable[pa.RecordBatch], name: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, base + limit, "right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets), of an array without nulls; offsets begin at 0."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], starts[i]+1, ... of lengths[i] values each, one after the other."""
    lengths = np.asarray(lengths, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - before, lengths)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]] for each i."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def hash_spans(data: np.ndarray, offsets: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    lengths = np.diff(offsets)
    place = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], lengths)
    cells = mix64(data.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(seed << 40))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(cells, out=total[1:])
    return mix64(total[offsets[1:]] - total[offsets[:-1]] + lengths.astype(np.uint64))


_BASE = 0xD1342543DE82EF95


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """A polynomial hash of each k consecutive 64-bit values; one entry per start."""
    values = values.astype(np.uint64, copy=False)
    if len(values) < k:
        return np.zeros(0, np.uint64)
    out, done, power, width = None, 0, values, 1
    while True:
        if k & width:
            if out is None:
                out, done = power, width
            else:  # what is done, then the next block of this width
                n = len(values) - done - width + 1
                out = out[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + power[done : done + n]
                done += width
        if done == k:
            return out
        n = len(power) - width
        power = power[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + power[width : width + n]
        width *= 2


def window_starts(offsets: np.ndarray, k: int) -> np.ndarray:
    """Start positions of all windows of k that lie within one document."""
    return ragged(offsets[:-1], np.maximum(np.diff(offsets) - k + 1, 0))


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost least value in each w consecutive ones."""
    if len(values) < w:
        return np.zeros(0, np.int64)
    best, at, width = values, np.arange(len(values), dtype=np.int64), 1
    while width < w:
        step = min(width, w - width)
        n = len(best) - step
        right = best[step : step + n] < best[:n]
        at = np.where(right, at[step : step + n], at[:n])
        best = np.where(right, best[step : step + n], best[:n])
        width += step
    return at


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches cut where ``key`` changes and joined where it does not: one per value."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key)
        if batch.num_rows > 1:
            edges = np.flatnonzero(pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)) + 1
        else:
            edges = np.zeros(0, np.int64)
        cuts = [0, *edges.tolist(), batch.num_rows]
        if held and held[0].column(key)[0] != values[0]:
            yield _one_batch(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a:
                yield _one_batch(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield _one_batch(held)


def _one_batch(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


@dataclass
class Words:
    """Words of a piece: ids into ``vocab``, and where each document's words begin and end."""

    ids: np.ndarray
    offsets: np.ndarray
    vocab: pa.Array
    _bytes: tuple = field(default=None, repr=False)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def vocab_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        if self._bytes is None:
            self._bytes = raw_bytes(self.vocab)
        return self._bytes

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per entry of the vocabulary."""
        return hash_spans(*self.vocab_bytes())


def split(texts: pa.Array) -> Words:
    """Words of texts without nulls."""
    lists = pc.ascii_split_whitespace(texts)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(full.to_numpy(zero_copy_only=False), out=kept[1:])
    coded = flat.filter(full).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(ids, kept[offsets], coded.dictionary)

