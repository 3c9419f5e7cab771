"""Quality rules: fixed counts per text, and a calibrated logistic regression on hashed n-grams.

Features of a text are its word unigrams, word bigrams and the character 1- to 3-grams of its words
(word ends count as a character), hashed into ``2**BITS`` columns; a value is the share of the
text's words that show it. As scores add up over words, a word of the vocabulary is scored once.

The classifier is fitted on the driver on at most ``train_rows`` labelled rows, chosen by the hash of
their id over the whole label table; their whole texts are used. Everything else reads all rows.

Nulls: a null text is empty, a null label or id is no label; a document with contradicting labels is
not used. Without both kinds of label the verdict is the rules' alone. A text without words has
chance 0 and fails the rules. Repeated rows get equal results, one per row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import learn
from tidemark.llm import words as W
from tidemark.llm.frames import annotate, unused

BITS = 16
SCALE = 8.0
RIDGE = 2e-4
TRAIN_ROWS = 3000
THRESHOLD = 0.5
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, quality double, kept boolean"
)

_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_MASK = np.uint64((1 << BITS) - 1)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # the last one is the bias
    slope: float
    shift: float


def repeated_words(words: W.Words, k: int = REPEAT_WINDOW) -> np.ndarray:
    """Words per text that lie in a window of k words found twice or more in that text.

    Windows are compared by 64-bit hashes, texts of one piece at a time.
    """
    starts = W.window_starts(words.offsets, k)
    if not len(starts):
        return np.zeros(len(words.offsets) - 1, np.int64)
    at = np.repeat(np.arange(len(words.offsets) - 1), np.maximum(words.counts - k + 1, 0))
    keys = W.mix64(W.rolling(W.mix64(words.ids), k)[starts] + W.mix64(at.astype(np.uint64)))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(words.offsets) - 1, np.int64)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    hit = starts[twice[place] == keys]
    edges = np.bincount(hit, minlength=len(words.ids) + 1) - np.bincount(hit + k, minlength=len(words.ids) + 1)
    return W.sums(np.cumsum(edges)[:-1] > 0, words.offsets)


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def counts(texts: pa.Array, words: W.Words) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    data, offsets = W.raw_bytes(texts)
    symbols = np.flatnonzero(_IS_SYMBOL[data])
    chars = pc.utf8_length(words.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    lines = [duplicate_lines(x) for x in texts.cast(pa.binary()).to_pylist()]
    return [
        words.counts,
        W.sums(chars[words.ids], words.offsets),
        np.diff(np.searchsorted(symbols, offsets)),
        np.array(lines, np.int64),
        repeated_words(words),
    ]


def grams(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the unigram and the character n-grams of each vocabulary entry, and their offsets."""
    data, offsets = words.vocab_bytes()
    lengths = np.diff(offsets) + 2  # a space before and behind
    ends = np.cumsum(lengths)
    starts = ends - lengths
    padded = np.full(int(lengths.sum()), 32, np.uint64)
    padded[W.ragged(starts + 1, lengths - 2)] = data
    columns, owners = [(W.mix64(words.hashes()) & _MASK).astype(np.int64)], [np.arange(len(lengths))]
    for n in (1, 2, 3):
        first = starts + (n == 1)
        many = np.maximum(lengths - n + 1 - 2 * (n == 1), 0)
        codes = W.rolling(W.mix64(padded + np.uint64(n << 20)), n)
        columns.append((W.mix64(codes[W.ragged(first, many)]) & _MASK).astype(np.int64))
        owners.append(np.repeat(np.arange(len(lengths)), many))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(columns)[order], np.searchsorted(owner[order], np.arange(len(lengths) + 1))


def bigrams(words: W.Words) -> np.ndarray:
    """Column of the bigram that ends at each word; -1 at the first word. A repeated word is one bigram."""
    h = words.hashes()[words.ids]
    pairs = np.where(h[1:] == h[:-1], np.uint64(1), W.mix64(h[:-1] * np.uint64(3) + h[1:]))
    out = np.concatenate([np.full(min(1, len(h)), -1, np.int64), (pairs & _MASK).astype(np.int64)])
    out[words.offsets[:-1][words.counts > 0]] = -1
    return out


def logits(words: W.Words, weights: np.ndarray) -> np.ndarray:
    columns, offsets = grams(words)
    pairs = bigrams(words)
    each = W.sums(weights[columns], offsets)[words.ids] + np.where(pairs >= 0, weights[pairs], 0.0)
    return SCALE * W.sums(each, words.offsets) / np.maximum(words.counts, 1) + weights[-1]


def features(words: W.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(columns, values) of each text."""
    columns, offsets = grams(words)
    pairs, out = bigrams(words), []
    for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True):
        own, bi = words.ids[a:b], pairs[a:b]
        all_columns = np.concatenate([columns[W.ragged(offsets[own], offsets[own + 1] - offsets[own])], bi[bi >= 0]])
        found, many = np.unique(all_columns, return_counts=True)
        out.append((found.astype(np.int32), (SCALE * many / max(1, b - a)).astype(np.float32)))
    return out


def one_label(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, y) of the documents whose labels agree."""
    rows = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).dropna()
    both = rows.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most"))
    return both.filter((F.col("y") == F.col("most")) & F.col("y").isin(0, 1)).select("id", "y")


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, label: str = "quality") -> Model:
    """Fits on four fifths of a sample of at most ``train_rows`` labelled rows, calibrates on the rest."""
    # at most train_rows pairs of numbers: the one broadcast here has that bound
    sample = one_label(labels, label).orderBy(F.xxhash64("id"), "id").limit(train_rows)
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(sample), "id")

    def run(batches):
        for piece in W.pieces(batches):
            found = features(W.split(W.text_column(piece)))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    piece.column("y"),
                    pa.array([c.tobytes() for c, _ in found], pa.binary()),
                    pa.array([v.tobytes() for _, v in found], pa.binary()),
                ],
                ["id", "y", "c", "v"],
            )

    schema = f"id {docs.schema['doc_id'].dataType.simpleString()}, y int, c binary, v binary"
    rows = texts.mapInArrow(run, schema).limit(2 * train_rows).collect()
    rows = sorted({(r.id, bytes(r.c)): r for r in rows}.values(), key=lambda r: (r.id, bytes(r.c)))
    y = np.array([r.y for r in rows], np.float64)
    if not 0 < y.sum() < len(y):
        return Model(np.append(np.zeros(1 << BITS), 40.0), 1.0, 0.0)
    held = W.mix64(np.arange(len(rows), dtype=np.uint64)) % np.uint64(5) == 0
    samples = [(np.frombuffer(r.c, np.int32), np.frombuffer(r.v, np.float32)) for r in rows]
    del rows
    learn.give_back()
    weights = learn.logistic([s for s, h in zip(samples, held, strict=True) if not h], y[~held], 1 << BITS, RIDGE)
    z = np.array([float(v @ weights[c]) for c, v in samples]) + weights[-1]
    slope, shift = learn.calibrate(z[held], y[held]) if 0 < y[held].sum() < held.sum() else (1.0, 0.0)
    del samples
    learn.give_back()
    return Model(weights, slope, shift)


def judge(docs: DataFrame, model: Model, into: str = "quality_rules", threshold: float = THRESHOLD) -> DataFrame:
    """docs with a struct column of the counts, the calibrated chance of good quality and the verdict."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.slope, model.shift))

    def compute(piece: pa.RecordBatch) -> list:
        weights, slope, shift = shared.value
        texts = W.text_column(piece)
        words = W.split(texts)
        numbers = counts(texts, words)
        failed = (numbers[0] < MIN_WORDS) | (100 * numbers[4] > REPEAT_PERCENT * numbers[0])
        learn.give_back()
        chance = np.where(numbers[0] > 0, learn.sigmoid(slope * logits(words, weights) + shift), 0.0)
        return [*numbers, failed, chance, ~failed & (chance >= threshold)]

    return annotate(docs, compute, FIELDS, into)


def op10(spark, sf_dir: str) -> DataFrame:
    """The counts and verdicts of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, model, "q").select("doc_id", "q.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass, with their own columns."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = unused(docs, "quality_rules")
    return judge(docs, model, name).filter(F.col(name)["kept"]).select(*docs.columns)
