"""Vector bin packing of token sequences by the dot-product heuristic.

A sequence has three limits at once: tokens, segments and loss-bearing tokens. An open sequence takes the
item whose demand has the greatest dot product with what is left of the limits, among those that fit. When
none fits, the item of the greatest product is cut so that it fills the sequence; its rest goes back to the
others. So sequences are full but for the last of a task, which are cut down to powers of two.

Which ids bear loss comes with the rows: none named, all do; a flag, the row's ids do or do not; ranges of ids, those in them do.
``conversations`` makes such rows of turns, where only the answers bear loss.

Every task packs its own rows: no shuffle, nothing gathered, and a task that runs again gives the same
sequences. At most ``BLOCK`` open rests of documents are held at a time.

Texts are encoded word by word, as the tokenizer's own pieces never cross the blanks between words; a
worker keeps the ids of recent words.

Nulls: a null text is empty and consists of its closing id only; a null id stays null. Repeated rows are
packed once each. An empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W

LIMIT = 2048
MAX_SEGMENTS = 256
END_ID = 1
BLOCK = 2048
_CACHE_IDS = 3_000_000
_CLOSING = ",.!?;:\"')]}>#*$%&|-_"
_PIECE = 8 << 20
COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class WordEncoder:
    """Ids of whole texts, from the ids of their words; keeps those of the words it has seen.

    A word's closing marks are looked up apart, and plain ASCII words in lower case, as the tokenizer
    parts and lowers them itself: this leaves fewer different words. New words go to the tokenizer many at a time,
    with a mark between them.
    """

    mark = "\x01"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark_id,) = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.starts, self.pool = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def learn(self, new: list[str]) -> None:
        """Adds the ids of new words."""
        plain = [w for w in new if self.mark not in w]
        odd = [w for w in new if self.mark in w]
        parts = []
        for i in range(0, len(plain), 1000):
            text = f" {self.mark} ".join([*plain[i : i + 1000], ""])
            parts.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == self.mark_id)
        lengths = np.diff(ends, prepend=-1) - 1
        if len(lengths) != len(plain):
            raise RuntimeError("the tokenizer does not keep words apart")
        more = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in odd]
        ids = np.concatenate([self.pool, ids[ids != self.mark_id], *(np.array(x, np.uint32) for x in more)])
        lengths = np.concatenate([lengths, np.array([len(x) for x in more], np.int64)])
        first = len(self.slots)
        self.slots.update(zip([*plain, *odd], range(first, first + len(new)), strict=True))
        self.pool, self.starts = ids, np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def slots_of(self, vocab: pa.Array) -> np.ndarray:
        """The slot of each entry, learned where it is new; call ``forget`` before, not between."""
        coded = vocab.dictionary_encode()
        words = coded.dictionary.to_pylist()
        slot = np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(slot < 0)
        if len(new):
            self.learn([words[i] for i in new])
            slot[new] = np.fromiter(map(self.slots.__getitem__, [words[i] for i in new]), np.int64, len(new))
        return slot[coded.indices.to_numpy(zero_copy_only=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets); texts without nulls."""
        words = W.split(texts)
        if len(self.pool) > _CACHE_IDS:
            self.forget()
        body = pc.utf8_rtrim(words.vocab, characters=_CLOSING)
        # only letters part from what follows whatever it is: else the word stays whole, and so with the one letter
        # whose lower case ends in a mark
        parts = pc.and_(pc.utf8_is_alpha(body), pc.invert(pc.match_substring(body, "\u0130")))
        body = pc.if_else(parts, body, words.vocab)
        tail = pc.binary_length(words.vocab).to_numpy() - pc.binary_length(body).to_numpy()
        data, offsets = words.vocab_bytes()
        text, some = data.tobytes(), tail > 0
        ends = offsets[1:][some]
        closing = pa.array([text[a:b] for a, b in zip((ends - tail[some]).tolist(), ends.tolist(), strict=True)], pa.binary())
        lower = pc.and_(pc.string_is_ascii(body), pc.invert(pc.match_substring(body, "<|")))
        body = pc.if_else(lower, pc.ascii_lower(body), body)
        slot = self.slots_of(pa.concat_arrays([body, closing.cast(pa.string())]))
        first = slot[: len(words.vocab)]
        second = np.full(len(first), -1, np.int64)
        second[some] = slot[len(first) :]
        # a word is one or two runs of the pool
        counts = 1 + some[words.ids]
        at = np.cumsum(counts) - counts
        runs = np.empty(int(counts.sum()), np.int64)
        runs[at] = first[words.ids]
        runs[at[counts == 2] + 1] = second[words.ids[counts == 2]]
        lengths = self.starts[runs + 1] - self.starts[runs]
        ends = np.zeros(len(runs) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        return self.pool[W.ragged(self.starts[runs], lengths)], ends[np.append(at, len(runs))[words.offsets]]


def encode_documents(texts: pa.Array, encoder: WordEncoder, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode``, each text closed by ``end_id``."""
    ids, offsets = encoder.encode(texts)
    counts = np.diff(offsets)
    ends = np.cumsum(counts + 1)
    out = np.empty(len(ids) + len(counts), np.uint32)
    out[W.ragged(ends - counts - 1, counts)] = ids
    out[ends - 1] = end_id
    return out, np.concatenate([np.zeros(1, np.int64), ends])


@dataclass
class Item:
    """A run of ids of one document that is not placed yet."""

    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int
    loss: np.ndarray | None = None  # which ids bear loss; None: all

    def demand(self) -> tuple[int, int, int]:
        return len(self.ids), 1, len(self.ids) if self.loss is None else int(self.loss.sum())

    def cut(self, n: int) -> tuple[Item, Item | None]:
        if n >= len(self.ids):
            return self, None
        a, b = (None, None) if self.loss is None else (self.loss[:n], self.loss[n:])
        return (
            Item(self.doc, self.start, self.ids[:n], self.doc_tokens, a),
            Item(self.doc, self.start + n, self.ids[n:], self.doc_tokens, b),
        )

    def fitting(self, left: list[int]) -> int:
        """How many of its first ids fit what is left."""
        n = int(min(len(self.ids), left[0])) if left[1] > 0 else 0
        if self.loss is None:
            return int(min(n, left[2]))
        return min(n, int(np.searchsorted(np.cumsum(self.loss), left[2], "right")))


def fill(items: list[Item], limits: tuple[int, int, int], last: bool) -> tuple[list[list[Item]], list[Item]]:
    """(closed sequences, items left over); with ``last`` nothing is left over."""
    pool: list[Item | None] = list(items)
    # one row per limit; what is placed has an endless demand
    demand = np.array([x.demand() for x in items], np.float64).reshape(-1, 3).T.copy()
    weight = [1.0 / (x * x) for x in limits]
    done, waiting, alive = [], int(demand[0].sum()), len(items)
    while alive and (last or waiting >= limits[0]):
        left, taken = list(limits), []
        while min(left) > 0 and alive:
            score = sum(d * (x * w) for d, x, w in zip(demand, left, weight, strict=True))
            fits = (demand[0] <= left[0]) & (demand[1] <= left[1]) & (demand[2] <= left[2])
            best = int(np.argmax(np.where(fits, score, -1.0)))
            if not fits[best]:
                best = int(np.argmax(np.where(score < np.inf, score, -1.0)))
            item = pool[best]
            n = item.fitting(left)
            if n == 0:
                break
            piece, rest = item.cut(n)
            taken.append(piece)
            left = [x - y for x, y in zip(left, piece.demand(), strict=True)]
            waiting -= n
            if rest is None:
                pool[best], demand[:, best], alive = None, np.inf, alive - 1
            else:
                pool[best], demand[:, best] = rest, rest.demand()
        length = sum(len(x.ids) for x in taken)
        if length < limits[0]:  # down to a power of two, which is not padded
            over = length - (1 << (length.bit_length() - 1))
            waiting += over
            while over:
                rest = taken.pop()
                if len(rest.ids) > over:
                    item, rest = rest.cut(len(rest.ids) - over)
                    taken.append(item)
                over -= len(rest.ids)
                pool.append(rest)
                demand, alive = np.hstack([demand, np.array(rest.demand(), np.float64)[:, None]]), alive + 1
        done.append(taken)
    return done, [x for x in pool if x is not None]


def rows_of(sequence: list[Item], number: int) -> Iterator[tuple]:
    offset = 0
    for x in sequence:
        yield x.doc, x.start, len(x.ids), zlib.crc32(x.ids.astype("<u4").tobytes()), x.doc_tokens, number, offset, x.ids
        offset += len(x.ids)


def pack(
    docs: DataFrame,
    path: str,
    limit: int = LIMIT,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    with_ids: bool = False,
    id_col: str = "doc_id",
    loss: str | None = None,
) -> DataFrame:
    """One row per piece of a document: where it begins, how long it is, and its place in a sequence.

    ``loss`` names a column that says which ids bear loss: a boolean for all of a row's, or an array of structs
    ``(start, length)`` of ranges of ids; null is none. It adds ``n_loss``, how many of a piece do. A sequence holds at most ``max_loss``
    of them. ``with_ids`` adds the ids themselves.
    """
    limits = (limit, max_segments, limit if max_loss is None else max_loss)
    whole = limits[2] >= limit
    if loss is not None and not isinstance(docs.schema[loss].dataType, T.BooleanType | T.ArrayType):
        raise TypeError(f"{loss} is neither a boolean nor an array of ranges")

    id_type = docs.schema[id_col].dataType
    schema = f"{id_col} {id_type.simpleString()}, " + ", ".join(f"{c} long" for c in COLUMNS)
    schema += ", n_loss long" if loss is not None else ""
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, kind, number = WordEncoder(path), None, TaskContext.get().partitionId() << 32
        held: list[Item] = []

        def out(sequences: list[list[Item]]) -> pa.RecordBatch:
            nonlocal number
            rows = []
            for sequence in sequences:
                rows += rows_of(sequence, number)
                number += 1
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            if loss is not None:
                arrays.append(pa.array([x.demand()[2] for sequence in sequences for x in sequence], pa.int64()))
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, [id_col, *COLUMNS, *["n_loss"] * (loss is not None), *["ids"] * with_ids])

        for piece in W.pieces(batches, limit=_PIECE):
            kind = piece.column(id_col).type
            ids, offsets = encode_documents(W.text_column(piece), encoder)
            full: list[list[Item]] = []
            said = [None] * piece.num_rows if loss is None else piece.column(loss).to_pylist()
            for doc, a, b, what in zip(piece.column(id_col).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), said, strict=True):
                tokens, start = b - a, 0
                bears = None if loss is None or what is True else loss_mask(what, tokens)
                while whole and tokens - start >= limit:
                    full.append([Item(doc, start, ids[a + start : a + start + limit], tokens, _part(bears, start, start + limit))])
                    start += limit
                if start < tokens:
                    held.append(Item(doc, start, ids[a + start : b].copy(), tokens, _part(bears, start, tokens)))
                if len(held) >= BLOCK:
                    closed, held = fill(held, limits, False)
                    full += closed
            if full:
                yield out(full)
        closed, held = fill(held, limits, True)
        if closed:
            yield out(closed)

    return docs.select(*dict.fromkeys([id_col, "text", *([loss] if loss else [])])).mapInArrow(run, schema)


def loss_mask(said: bool | list | None, tokens: int) -> np.ndarray:
    """Which of a row's ids bear loss; ranges may overlap, and are cut at the row's ends."""
    mask = np.zeros(tokens, np.bool_)
    for part in said or ():
        start, length = (part["start"] or 0), (part["length"] or 0)
        mask[max(0, start) : max(0, start + length)] = True
    return mask


def _part(mask: np.ndarray | None, a: int, b: int) -> np.ndarray | None:
    return None if mask is None else mask[a:b]


def conversations(turns: DataFrame, answering: str = "assistant", id_col: str = "conv_id") -> DataFrame:
    """Rows to pack of turns (conv_id, turn, role, text): each turn a row ``doc_id`` struct, the text, and whether it bears loss.

    Turns of one conversation stay next to each other, in order, in one task or, where it is long, in neighbouring ones: they are
    dealt out by ranges of conversation and turn.
    """
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select(
        F.struct(F.col(id_col), F.col("turn")).alias("doc_id"), "text", F.coalesce(F.col("role") == answering, F.lit(False)).alias("loss")
    )
    return rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path())


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What training reads: the pieces of all sequences with their ids."""
    return pack(docs, default_path(), with_ids=True)
