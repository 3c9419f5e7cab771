"""The pipeline's stages one after another, and the registered queries against their SQL."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import brute
import corpus_pipeline
from checks import compare
from tidemark.llm import mixing, packing, pii, quality
from tidemark.llm import words as W
from tidemark.llm.frames import Scratch, annotate, unused
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents, and what each stage returns, written and read again."""
    scratch, out = Scratch(spark, "test-pipeline"), [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(scratch.table(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def test_stages(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-dedup", "personal data", "mixing", "packing"]
    columns = steps[0].columns
    assert all(s.columns == columns for s in steps[1:5])
    tables = [{r.doc_id: r for r in s.collect()} for s in steps[:5]]
    start, good, distinct, masked, mixed = tables
    assert set(mixed) <= set(masked) == set(distinct) <= set(good) <= set(start)
    # quality: short and repetitive texts go
    assert all(len(brute.words(r.text)) >= 20 for r in good.values())
    assert all(good[i] == start[i] for i in good) and all(distinct[i] == good[i] for i in distinct)
    # near-dedup: the first document of each group stays
    rows = [(i, r.text) for i, r in sorted(good.items())]
    groups = brute.near(rows, [0] * len(rows))
    assert set(distinct) == {i for (i, _), (size, component) in groups.items() if not size or component == i}
    # personal data: none left, other texts as they were
    assert not any(brute.personal(r.text) for r in masked.values())
    assert all(masked[i] == distinct[i] for i in masked if not brute.personal(distinct[i].text) and masked[i].text == distinct[i].text)
    # packing: every document of the last step, whole
    pieces = defaultdict(list)
    for r in steps[5].collect():
        pieces[r.doc_id].append(r)
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert set(pieces) == set(mixed)
    assert all(sum(p.length for p in own) == own[0].doc_tokens for own in pieces.values())


def _word_hashes(texts):
    vocabulary = sorted({w for t in texts for w in brute.words(t)})
    return dict(zip(vocabulary, W.split(pa.array(vocabulary)).hashes().tolist(), strict=True)) if vocabulary else {}


def test_stages_are_those_of_brute_force(spark, steps):
    """The rows that each stage keeps, and what it makes of them, by plain versions on its own input."""
    start, good, distinct, clean, mixed = ({r.doc_id: r for r in s.collect()} for s in steps[:5])
    # quality: the counts by plain windows, the verdict by a text's features one by one
    model = quality.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept, open_calls = set(), set()
    for i, r in start.items():
        own = brute.words(r.text)
        if len(own) < quality.MIN_WORDS or 100 * brute.repeated_words(own) > quality.REPEAT_PERCENT * len(own):
            continue
        ((columns, values),) = quality.features(W.split(pa.array([r.text])))
        z = sum(float(v) * model.weights[c] for c, v in zip(columns, values, strict=True)) + model.weights[-1]
        chance = 1 / (1 + math.exp(-(model.slope * z + model.shift)))
        if abs(chance - quality.THRESHOLD) < 1e-6:
            open_calls.add(i)
        if chance >= quality.THRESHOLD:
            kept.add(i)
    assert set(good) - open_calls == kept - open_calls and len(open_calls) < 3
    # personal data: the base spans are the plain ones, and the text is masked by all spans
    for i, r in distinct.items():
        spans = pii.find(r.text)
        assert [s for s in spans if s[0] in pii.BASE] == brute.personal(r.text)
        wanted = brute.masked(r.text, spans)
        assert clean[i].text == wanted and clean[i].n_chars == (len(wanted) if spans else r.n_chars)
        assert (clean[i].lang, clean[i].source) == (r.lang, r.source)
    # mixing: topics, cells, capped fitting and draws
    hashes = _word_hashes(r.text for r in clean.values())
    tokens, cell = defaultdict(int), {}
    for i, r in clean.items():
        cell[i] = (r.source, r.lang, brute.topic(r.text, hashes, mixing.TOPIC_BITS, mixing.TOPIC_WORD_BYTES))
        tokens[cell[i]] += len(brute.words(r.text))
    powers = [mixing.POWERS[d] for d in ("source", "lang", "topic")]
    chances = brute.capped_fitting(list(tokens.items()), powers, mixing.SWEEPS, mixing.BUDGET)
    gap = {i: chances[cell[i]] - brute.draw(i, mixing.SEED) for i in clean}
    close = {i for i, g in gap.items() if abs(g) < 1e-4}
    assert set(mixed) - close == {i for i, g in gap.items() if g > 0} - close and len(close) < 5
    assert all(mixed[i] == clean[i] for i in mixed)
    # packing: the ids of the masked texts, each once and in order, in gapless sequences
    tokenizer, pieces, sequences = Tokenizer.from_file(packing.default_path()), defaultdict(list), defaultdict(list)
    for r in sorted(steps[5].collect(), key=lambda r: (r.start, r.offset)):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, r in mixed.items():
        ids = [x for p in pieces[i] for x in p.ids]
        assert ids == [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        assert [p.start for p in pieces[i]] == np.cumsum([0, *[p.length for p in pieces[i]]])[:-1].tolist()
    for own in sequences.values():
        assert [a for a, _ in sorted(own)] == np.cumsum([0, *[n for _, n in sorted(own)]])[:-1].tolist()
        assert sum(n for _, n in own) <= 2048


def test_run_is_the_stages(spark, steps):
    def rows(df):
        return Counter((r.doc_id, r.doc_tokens) for r in df.select("doc_id", "doc_tokens").distinct().collect())

    out = corpus_pipeline.run(spark, SF)
    assert out.columns == steps[5].columns and rows(out) == rows(steps[5])


def test_stages_on_edges(spark):
    docs = brute.documents(spark)
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs.limit(0), SF).count() == 0


def test_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} and {*QUERIES, "pipeline"} <= names
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    sf = "/root/testdata/sf0.001"
    assert compare.difference(spark, compare.database(sf), name, sf) is None


# one of these has a row per negative, the other one per part, order and step
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_hard_negatives", "op13_filter_audit"}))
def test_one_row_per_document(spark, name):
    sf = "/root/testdata/sf0.001"
    out = QUERIES[name](spark, sf)
    table, key = {"op4_url_filters": ("pages", "page_id"), "op7_embedding_near_dedup": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    ids = spark.read.parquet(f"{sf}/{table}.parquet").select(key)
    assert out.select(key).distinct().count() == ids.distinct().count()
    if name != "op5_packing":
        assert out.count() == ids.count()


def test_annotate_keeps_other_columns(spark):
    df = brute.documents(spark)
    out = annotate(df, lambda piece: [[len(x or "") for x in piece.column("text").to_pylist()]], "n long", "made")
    assert all(r.made.n == len(r.text or "") for r in out.collect())
    with pytest.raises(ValueError, match="already"):
        annotate(df, lambda piece: [], "n long", "KEPT")
    assert unused(df, "kept") == "_kept" and unused(df, "m") == "m" and unused(df, "_m") == "__m"
    assert out.select(F.sum("made.n")).first()[0] == sum(len(t or "") for _, t in brute.texts())
