"""Toxic spans by a linear-chain conditional random field over the words of a text.

States are clean and toxic. A word's emission is a sum of weights of hashed features of its lower-cased,
trimmed form: itself, its beginnings and its endings; transitions and the start have weights of their own.

Labels are per document, so training words are labelled by cues: features found in far more toxic than
clean documents of the sample. A word of a toxic document with such a feature is labelled toxic, every other
word clean; the field is then fitted to these labels (L-BFGS on the exact log-likelihood). A logistic
regression on a third of the sample, kept out of the field's fit, turns a document's marginals (their sum, its
share of the words, the largest, the odds that any word is toxic) into a calibrated score.

Scoring runs forward-backward over whole texts. Blocks of ``BLOCK`` words first give their 2x2 products, these
are chained per text, and the blocks are then finished from their exact ends: same marginals, wide arrays.

The sample is at most ``TRAIN_ROWS`` labelled rows of the training folds, chosen by the hash of the id over all
of them, and where it holds fewer than ``LEAST`` of a label up to so many more of that label; whole texts up to
``TRAIN_TEXT_BYTES``, ``TRAIN_BYTES`` in all. A sample with more of a label than all labels have is made up for in
the score's bias. With few toxic texts cues need fewer of them. Labels, language, source and id are no inputs of a score.

Nulls: a null text is empty; a text without words gets the score of no evidence. A null or contradicting label
is no label. With one kind of label, or none, every score is the share of toxic labels. Repeated rows get equal results, one per row.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import learn
from tidemark.llm import words as W
from tidemark.llm.frames import annotate
from tidemark.llm.quality import one_label

BITS = 18
TRAIN_ROWS = 3000
TRAIN_TEXT_BYTES = 256 << 10
TRAIN_BYTES = 128 << 20
LEAST = 200
BLOCK = 128
RIDGE = 0.02
CUE_DOCS = 4
CUE_ODDS = 8.0
THRESHOLD = 0.7
CERTAIN = 1e3  # the bias of a model that has seen one label only
SPAN_MARGINAL = 0.5
BEGINNINGS = (3, 4, 5, 6, 7, 8)  # bytes
ENDINGS = (3, 5)
TRIM = " \t\n.,;:!?\"'()[]{}<>|#*$%&+-_=/\\~`^@0123456789"
FIELDS = "score double, predicted int, toxic_words double, spans string"

_MASK = np.uint64((1 << BITS) - 1)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per feature
    chain: np.ndarray  # log potentials: start clean, start toxic, then clean-clean, clean-toxic, toxic-clean, toxic-toxic
    document: np.ndarray  # logistic weights of the document's numbers, and the bias


def features(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature columns, offsets) of each word; a word that trims to nothing has none."""
    plain = pc.utf8_trim(pc.utf8_lower(vocab), characters=TRIM)
    data, offsets = W.raw_bytes(plain)
    lengths = np.diff(offsets)
    n = len(lengths)
    place = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], lengths)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(W.mix64(data.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8))), out=total[1:])
    back = np.repeat(offsets[1:], lengths) - np.arange(len(data), dtype=np.int64)
    total_back = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(W.mix64(data.astype(np.uint64) + (back.astype(np.uint64) << np.uint64(8))), out=total_back[1:])
    columns, owners = [], []

    def add(kind: int, who: np.ndarray, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        columns.append((W.mix64(sums[b] - sums[a] + np.uint64(kind << 56)) & _MASK).astype(np.int64))
        owners.append(who)

    some = np.flatnonzero(lengths > 0)
    add(1, some, total, offsets[some], offsets[some + 1])
    for k in BEGINNINGS:
        long = np.flatnonzero(lengths >= k)
        add(2 + k, long, total, offsets[long], offsets[long] + k)
    for k in ENDINGS:
        long = np.flatnonzero(lengths >= k)
        add(20 + k, long, total_back, offsets[long + 1] - k, offsets[long + 1])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(columns)[order], np.searchsorted(owner[order], np.arange(n + 1))


def _blocks(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of each block; a text's blocks follow one another."""
    counts = np.diff(offsets)
    many = -(-counts // size)
    text = np.repeat(np.arange(len(counts)), many)
    first = W.ragged(np.zeros(len(counts), np.int64), many) * size + offsets[text]
    return text, first, np.minimum(size, offsets[text + 1] - first)


def _grid(values: np.ndarray, first: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """values as [place, block], and which places are filled."""
    place = np.arange(size)[:, None]
    filled = place < lengths[None, :]
    return np.where(filled, values[np.minimum(first[None, :] + place, len(values) - 1)], 0.0), filled


def _forward(emit: np.ndarray, filled: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Scaled forward vectors [place + 1, block, ..., 2]; start is the vector before each block's first word."""
    out = np.empty((len(emit) + 1, *start.shape))
    out[0] = start
    extra = (1,) * (start.ndim - 2)
    for t in range(len(emit)):
        at = out[t]
        e = emit[t].reshape(-1, *extra)
        clean = at[..., 0] * step[0, 0] + at[..., 1] * step[1, 0]
        toxic = (at[..., 0] * step[0, 1] + at[..., 1] * step[1, 1]) * e
        both = clean + toxic
        if extra:  # a product of matrices: one scale for all its rows
            both = np.broadcast_to(both.max(axis=-1, keepdims=True), both.shape)
        keep = filled[t].reshape(-1, *extra)
        out[t + 1, ..., 0] = np.where(keep, clean / both, at[..., 0])
        out[t + 1, ..., 1] = np.where(keep, toxic / both, at[..., 1])
    return out


def _backward(emit: np.ndarray, filled: np.ndarray, end: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Scaled backward vectors [place + 1, block, 2]; end is the vector after each block's last word."""
    out = np.empty((len(emit) + 1, *end.shape))
    out[-1] = end
    for t in range(len(emit) - 1, -1, -1):
        at = out[t + 1]
        toxic = at[:, 1] * emit[t]
        zero, one = step[0, 0] * at[:, 0] + step[0, 1] * toxic, step[1, 0] * at[:, 0] + step[1, 1] * toxic
        both = zero + one
        out[t, :, 0] = np.where(filled[t], zero / both, at[:, 0])
        out[t, :, 1] = np.where(filled[t], one / both, at[:, 1])
    return out


def _scaled(v: np.ndarray) -> np.ndarray:
    return v / v.sum(axis=-1, keepdims=True)


def marginals(unary: np.ndarray, offsets: np.ndarray, chain: np.ndarray, size: int = BLOCK) -> np.ndarray:
    """The chance of the toxic state of each word, texts being chains of their own."""
    if not len(unary):
        return np.zeros(0)
    step, begin = np.exp(chain[2:].reshape(2, 2)), _scaled(np.exp(chain[:2]))
    text, first, lengths = _blocks(offsets, size)
    emit, filled = _grid(np.exp(np.clip(unary, -30, 30)), first, lengths, size)
    # the start weights take the place of a transition into the first word: begin = before @ step
    before = np.linalg.solve(step.T, begin)
    product = _forward(emit, filled, np.broadcast_to(np.eye(2), (len(text), 2, 2)), step)[-1]
    heads = np.searchsorted(text, np.arange(len(offsets)))
    many = np.diff(heads)
    front, rear = np.empty((len(text), 2)), np.empty((len(text), 2))
    at, order = np.broadcast_to(before, (len(many), 2)).copy(), np.argsort(-many, kind="stable")
    for j in range(int(many.max(initial=0))):
        who = order[: int((many > j).sum())]
        here = heads[who] + j
        front[here] = at[who]
        at[who] = np.einsum("bi,bij->bj", at[who], product[here])
        at[who] /= np.abs(at[who]).sum(axis=1, keepdims=True)
    at = np.ones((len(many), 2))
    for j in range(int(many.max(initial=0))):
        who = order[: int((many > j).sum())]
        here = heads[who + 1] - 1 - j
        rear[here] = at[who]
        at[who] = _scaled(np.einsum("bij,bj->bi", product[here], at[who]))
    ahead = _forward(emit, filled, front, step)[1:]
    behind = _backward(emit, filled, rear, step)[1:]
    joint = ahead * behind
    toxic = joint[..., 1] / joint.sum(axis=-1)
    out = np.empty(len(unary))
    place = np.broadcast_to(first[None, :] + np.arange(size)[:, None], filled.shape)
    out[place[filled]] = toxic[filled]
    return out


def fit_chain(
    ids: np.ndarray, offsets: np.ndarray, marked: np.ndarray, columns: np.ndarray, column_offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights, chain) that maximise the likelihood of the marks; chains are blocks of words here."""
    _, first, lengths = _blocks(offsets, BLOCK)
    used, local = np.unique(columns, return_inverse=True)
    owner = np.repeat(np.arange(len(column_offsets) - 1), np.diff(column_offsets))
    y, filled = _grid(marked.astype(np.float64), first, lengths, BLOCK)
    place = np.minimum(first[None, :] + np.arange(BLOCK)[:, None], len(ids) - 1)
    types, n_types, n_words = ids[place], len(column_offsets) - 1, max(1, int(filled.sum()))
    pair = filled[1:] & filled[:-1]
    seen = np.bincount(types[filled], y[filled], n_types)
    start_seen = np.array([(1 - y[0]).sum(), y[0].sum()])
    step_seen = np.array([[((1 - y[:-1]) * (1 - y[1:]))[pair].sum(), ((1 - y[:-1]) * y[1:])[pair].sum()],
                          [(y[:-1] * (1 - y[1:]))[pair].sum(), (y[:-1] * y[1:])[pair].sum()]])

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, begin, step = x[:-6], np.exp(x[-6:-4]), np.exp(x[-4:].reshape(2, 2))
        unary = np.clip(np.bincount(owner, weights[local], n_types), -30, 30)
        emit = np.where(filled, np.exp(unary)[types], 1.0)
        alpha, log_z = np.empty((BLOCK, len(first), 2)), np.zeros(len(first))
        at = np.stack([np.full(len(first), begin[0]), begin[1] * emit[0]], axis=1)
        for t in range(BLOCK):
            if t:
                new = at @ step
                new[:, 1] *= emit[t]
                at = np.where(filled[t][:, None], new, at)
            total = at.sum(axis=1)
            log_z += np.log(total)
            at = at / total[:, None]
            alpha[t] = at
        beta, expected = np.ones((len(first), 2)), np.zeros((2, 2))
        toxic = np.empty((BLOCK, len(first)))
        for t in range(BLOCK - 1, -1, -1):
            joint = alpha[t] * beta
            toxic[t] = joint[:, 1] / joint.sum(axis=1)
            if t:
                right = beta * np.stack([np.ones(len(first)), emit[t]], axis=1)
                xi = alpha[t - 1][:, :, None] * step[None] * right[:, None, :]
                xi /= xi.sum(axis=(1, 2), keepdims=True)
                expected += xi[filled[t]].sum(axis=0)
                new = right @ step.T
                beta = np.where(filled[t][:, None], new / new.sum(axis=1, keepdims=True), beta)
        likelihood = (seen * unary).sum() + start_seen @ x[-6:-4] + (step_seen.ravel() @ x[-4:]) - log_z.sum()
        by_type = np.bincount(types[filled], toxic[filled], n_types) - seen
        grad = np.concatenate([
            np.bincount(local, by_type[owner], len(used)),
            np.array([(1 - toxic[0]).sum(), toxic[0].sum()]) - start_seen,
            (expected - step_seen).ravel(),
        ])
        scale = 1.0 / n_words
        ridge = RIDGE * scale
        return float(-likelihood * scale + 0.5 * ridge * x @ x), grad * scale + ridge * x

    x = learn.lbfgs(loss, np.zeros(len(used) + 6), steps=60)
    weights = np.zeros(1 << BITS)
    weights[used] = x[:-6]
    return weights, x[-6:]


def _distinct(words: W.Words, hashes: np.ndarray) -> np.ndarray:
    """Indices of texts with different sets of smallest word hashes: one of each family of near copies."""
    seen, out = set(), []
    for i in range(len(words.counts)):
        own = np.unique(hashes[words.ids[words.offsets[i] : words.offsets[i + 1]]])[:4].tobytes()
        if own not in seen:
            seen.add(own)
            out.append(i)
    return np.array(out, np.int64)


def cues(
    words: W.Words, y: np.ndarray, columns: np.ndarray, offsets: np.ndarray, texts: np.ndarray, least: int = CUE_DOCS
) -> np.ndarray:
    """Mask over features: those in at least ``least`` toxic texts and CUE_ODDS times as often as in clean ones."""
    found = np.zeros((2, 1 << BITS))
    for i in texts:
        own = np.unique(words.ids[words.offsets[i] : words.offsets[i + 1]])
        found[int(y[i]), np.unique(columns[W.ragged(offsets[own], offsets[own + 1] - offsets[own])])] += 1
    toxic, clean = max(1, int(y[texts].sum())), max(1, int((1 - y[texts]).sum()))
    rate = ((found[1] + 0.1) / toxic) / ((found[0] + 0.5) / clean)
    return (found[1] >= least) & (rate >= CUE_ODDS)


def document_numbers(chances: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, from its marginals: log of 1 + their sum, ten times their share of the words, the largest one,
    and the log-odds that any word is toxic."""
    counts, total = np.diff(offsets), W.sums(chances, offsets)
    top = np.zeros(len(counts))
    if len(chances):
        some = np.flatnonzero(counts > 0)
        top[some] = np.maximum.reduceat(chances, offsets[:-1][some])
    none = np.maximum(W.sums(-np.log1p(-np.minimum(chances, 1 - 1e-6)), offsets), 1e-6)  # -log of no toxic word
    odds = np.clip(np.log(np.expm1(np.minimum(none, 30.0))), -8.0, 12.0) / 4.0
    return np.stack([np.log1p(total), np.minimum(1.0, 10 * total / np.maximum(counts, 1)), top, odds], axis=1)


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int, label: str) -> tuple[list, float]:
    """(rows with id, text and y, share of label 1 among all labels)."""
    known = one_label(labels, label)
    by_label = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}  # two rows
    order = [F.xxhash64("id"), F.col("id")]
    sample = known.orderBy(*order).limit(train_rows)
    drawn = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    for y, n in by_label.items():
        if drawn.get(y, 0) < min(LEAST, n):
            sample = sample.unionByName(known.filter(F.col("y") == y).orderBy(*order).limit(LEAST)).distinct()
    # at most train_rows + LEAST pairs of numbers: the one broadcast here has that bound
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(sample), "id")
    texts = texts.filter(F.octet_length("text") <= TRAIN_TEXT_BYTES)
    sizes = texts.select("id", F.octet_length("text").alias("n")).limit(2 * (train_rows + LEAST)).collect()
    if sum(r["n"] for r in sizes) > TRAIN_BYTES:
        # the same share of all lengths
        share = TRAIN_BYTES / sum(r["n"] for r in sizes)
        texts = texts.filter((F.pmod(F.xxhash64("id", F.lit("bytes")), F.lit(1 << 20)) < int(share * (1 << 20))))
    rows = texts.limit(2 * (train_rows + LEAST)).collect()
    rows = sorted({(r.id, r.text): r for r in rows}.values(), key=lambda r: (r.id, r.text))
    return rows, by_label.get(1, 0) / max(1, sum(by_label.values()))


def _constant(share: float) -> Model:
    """Gives every text the same score."""
    bias = np.log(share / (1 - share)) if 0 < share < 1 else (CERTAIN if share else -CERTAIN)
    never = np.array([0.0, -20.0, 0.0, -20.0, 0.0, -10.0])
    return Model(np.zeros(1 << BITS), never, np.array([0.0, 0.0, 0.0, 0.0, bias]))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, label: str = "toxic") -> Model:
    """Fits on labelled rows; callers leave held-out rows out of ``labels``."""
    rows, share = training_rows(docs, labels, train_rows, label)
    y = np.array([r.y for r in rows], np.float64)
    if not 0 < y.sum() < len(y):
        return _constant(share)
    words = W.split(pa.array([r.text for r in rows], pa.string()))
    columns, offsets = features(words.vocab)
    held = W.mix64(np.arange(len(rows), dtype=np.uint64)) % np.uint64(3) == 0
    if not y[~held].any():
        held &= y == 0
    distinct = _distinct(words, words.hashes())
    for least in range(CUE_DOCS, 0, -1):
        is_cue = cues(words, y, columns, offsets, distinct[~held[distinct]], least)
        cue_word = W.sums(is_cue[columns].astype(np.int64), offsets) > 0
        marked = cue_word[words.ids] & np.repeat(y == 1, words.counts)
        if (marked & ~np.repeat(held, words.counts)).any():
            break
    # the field is fitted to the toxic texts and as many clean ones, drawn by a hash of the text
    clean = np.flatnonzero((y == 0) & ~held)
    clean = clean[np.argsort([crc32(rows[i].text.encode()) for i in clean], kind="stable")]
    chosen = np.sort(np.concatenate([np.flatnonzero((y == 1) & ~held), clean[: max(300, int(y.sum()))]]))
    take = W.ragged(words.offsets[:-1][chosen], words.counts[chosen])
    lengths = np.concatenate([np.zeros(1, np.int64), np.cumsum(words.counts[chosen])])
    if not marked[take].any():
        return _constant(share)
    weights, chain = fit_chain(words.ids[take], lengths, marked[take], columns, offsets)
    unary = W.sums(weights[columns], offsets)[words.ids]
    x = document_numbers(marginals(unary, words.offsets, chain), words.offsets)
    some = held if 0 < y[held].sum() < held.sum() else np.ones(len(y), bool)
    names = np.arange(x.shape[1])
    document = learn.logistic([(names, row) for row in x[some]], y[some], x.shape[1], 1e-4)
    drawn = y.mean()
    if drawn > 2 * share or 1 - drawn > 2 * (1 - share):
        document[-1] += np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
    return Model(weights, chain, document)


def _spans(text: bytes, toxic: np.ndarray) -> str:
    """Code point ranges of the runs of toxic words: ``start:end`` joined by commas."""
    import re

    plain = text.decode("utf-8", "replace")
    places = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", plain)]
    out: list[list[int]] = []
    for i in np.flatnonzero(toxic):
        start, end = places[i]
        if out and i and toxic[i - 1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return ",".join(f"{a}:{b}" for a, b in out)


def score(docs: DataFrame, model: Model, into: str = "toxicity", threshold: float = THRESHOLD) -> DataFrame:
    """docs with a struct column: score, verdict, expected toxic words and the offending ranges."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(piece: pa.RecordBatch) -> list:
        field, texts = shared.value, W.text_column(piece)
        words = W.split(texts)
        columns, offsets = features(words.vocab)
        unary = W.sums(field.weights[columns], offsets)[words.ids]
        chances = marginals(unary, words.offsets, field.chain)
        result = learn.sigmoid(document_numbers(chances, words.offsets) @ field.document[:-1] + field.document[-1])
        if abs(field.document[-1]) >= CERTAIN:
            result = np.full(len(result), float(field.document[-1] > 0))
        toxic = chances >= SPAN_MARGINAL
        hits = W.sums(toxic.astype(np.int64), words.offsets) > 0
        raw = texts.cast(pa.binary())
        spans = [
            _spans(raw[i].as_py(), toxic[words.offsets[i] : words.offsets[i + 1]]) if hit else ""
            for i, hit in enumerate(hits)
        ]
        return [result, (result >= threshold).astype(np.int32), W.sums(chances, words.offsets), pa.array(spans, pa.string())]

    return annotate(docs, compute, FIELDS, into)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def op2(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    return score(docs, fit(docs, labels), "t").select("doc_id", held_out().alias("held_out"), "t.*")
