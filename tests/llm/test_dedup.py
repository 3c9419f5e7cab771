"""Substring, suffix-array and near-duplicate removal against plain versions."""

from __future__ import annotations

import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from tidemark.llm import near, substring, suffixes
from tidemark.llm import words as W
from tidemark.llm.components import components
from tidemark.llm.frames import Scratch, file_limit, row_key


@pytest.fixture(scope="module")
def docs(spark):
    return brute.documents(spark).repartition(5)


@pytest.fixture(scope="module")
def hashes(spark):
    rows = brute.texts()
    df = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "k int, doc_id long, text string")
    return [r.h for r in df.select("k", row_key()["h"].alias("h")).orderBy("k").collect()]


def _expected(found: dict, hashes: list[int]) -> list[tuple]:
    """A row for each row of the table, repeated ones included."""
    return sorted(((i, *found[i, h]) for (i, _), h in zip(brute.texts(), hashes, strict=True)), key=repr)


def _rows(df, columns: list[str]) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("crowd", [2000, 1])
def test_substring(docs, hashes, monkeypatch, crowd):
    monkeypatch.setattr(substring, "CROWD", crowd)
    out = substring.dedup(docs).withColumn("id", F.when(F.col("id") != -(2**63), F.col("id")))
    assert _rows(out, ["id", "n_words", "n_removed", "sha"]) == _expected(brute.substring(brute.texts(), hashes), hashes)


@pytest.mark.parametrize("crowd", [1000, 1])
def test_suffixes(docs, hashes, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    out = suffixes.dedup(docs).withColumn("id", F.when(F.col("id") != -(2**63), F.col("id")))
    expected = _expected(brute.suffixes(brute.texts(), hashes), hashes)
    assert _rows(out, ["id", "n_bytes", "n_removed", "n_spans", "sha"]) == expected


def _crowd(n: int) -> list[tuple[int, str]]:
    """Texts around one passage: ends of many lengths in common, near ones too, and some whole copies."""
    passage, ends = brute.prose(70, 90), [brute.prose(71 + k, 60) for k in range(7)]
    out = []
    for k in range(n):
        left, right = ends[k % 7], ends[(k // 7) % 7]
        out.append((k, f"{k * 7919} {left[: 10 + 13 * (k % 11)]} {passage} {right[: 5 + 29 * (k % 5)]}{k if k % 3 else ''}{right}"))
    return out + [(n + k, t) for k, (_, t) in enumerate(out[:4])]


@pytest.mark.parametrize("crowd", [10, 2])
def test_crowded_anchors_are_split_by_distance(spark, monkeypatch, crowd):
    """Ranges of one string, of a few and of many: dropped, sorted, compared by digests."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    seen, digests = [], suffixes.repeats_by_digest

    def counted(rows):
        seen.append(rows.count())
        return digests(rows)

    monkeypatch.setattr(suffixes, "repeats_by_digest", counted)
    rows = _crowd(60)
    docs = brute.documents(spark, rows).repartition(4)
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", row_key()["h"].alias("h")).collect()}
    found = brute.suffixes(rows, [hashes[i] for i, _ in rows])
    expected = sorted(((i, *found[i, hashes[i]]) for i, _ in rows), key=repr)
    out = _rows(suffixes.dedup(docs), ["id", "n_bytes", "n_removed", "n_spans", "sha"])
    assert out == expected and any(r[2] for r in out)
    assert seen[0] > 0


@pytest.mark.parametrize("crowd", [12, 2])
def test_crowded_buckets_are_split_by_distance(spark, monkeypatch, crowd):
    """As above, with windows of words."""
    monkeypatch.setattr(substring, "CROWD", crowd)
    passage, rows = brute.prose(90, 24), []
    for k in range(60):
        left, right = brute.prose(91 + k % 7, 16).split(), brute.prose(101 + k // 7 % 7, 16).split()
        rows.append((k, " ".join([f"a{k}", *left[k % 5 :], passage, *right[: 4 + k % 11], f"b{k}", *right])))
    rows += [(100 + k, rows[k][1]) for k in range(4)]
    docs = brute.documents(spark, rows).repartition(4)
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", row_key()["h"].alias("h")).collect()}
    seen = {}

    def counted(name):
        step = getattr(substring, name)

        def run(crowded):
            seen[name] = crowded.count()
            return step(crowded)

        monkeypatch.setattr(substring, name, run)

    counted("by_distance")
    counted("repeats_by_window")
    found = brute.substring(rows, [hashes[i] for i, _ in rows])
    out = _rows(substring.dedup(docs), ["id", "n_words", "n_removed", "sha"])
    assert out == sorted(((i, *found[i, hashes[i]]) for i, _ in rows), key=repr) and any(r[2] for r in out)
    assert seen["by_distance"] > 12 and (seen["repeats_by_window"] > 0) == (crowd == 2)


def test_ranges_hold_each_window_once(spark):
    """Cut strings have the windows of the whole one, with the anchor where it was."""
    rng = np.random.default_rng(5)
    rows = []
    for k, size in enumerate((400, 401, 470, 736, 600)):
        string = bytes(rng.integers(97, 101, size, np.uint8))
        low, high = max(0, size - 400), 336  # the anchor lies in every window
        rows.append((b"x", string, int(rng.integers(low, high + 1)), k, 0, 1000 * k, 1))
    df = spark.createDataFrame(rows, "lead binary, string binary, at int, id long, h long, pos long, times long")
    windows: dict[int, list] = {k: [] for k in range(len(rows))}
    for r in suffixes.by_distance(df).collect():
        whole = rows[r.id]
        for j in range(len(r.string) - 399):
            start = r.pos - whole[5] + j
            assert bytes(r.string[j : j + 400]) == whole[1][start : start + 400] and start + (r["at"] - j) == whole[2]
            assert bytes(r.lead[1:]) in bytes(r.string[j : j + 400]) and len(r.lead) >= 350
            windows[r.id].append(start)
    assert all(sorted(windows[k]) == list(range(len(rows[k][1]) - 399)) for k in windows)


@pytest.mark.parametrize("crowd", [256, 1])
def test_near(docs, hashes, monkeypatch, crowd):
    monkeypatch.setattr(near, "CROWD", crowd)
    out = near.groups(docs)
    out = out.select("id", "n_shingles", F.col("component.id").alias("c"))
    out = out.withColumns({c: F.when(F.col(c) != -(2**63), F.col(c)) for c in ("id", "c")})
    assert _rows(out, ["id", "n_shingles", "c"]) == _expected(brute.near(brute.texts(), hashes), hashes)


def test_near_stage_keeps_one_of_each_group(spark, docs, hashes):
    out = near.stage(spark, docs, "")
    assert out.columns == docs.columns
    groups = brute.near(brute.texts(), hashes)
    kept = {(r.doc_id, r.text) for r in out.collect()}
    assert out.count() == len(kept)  # repeated rows once
    first = {}
    for (i, t), h in zip(brute.texts(), hashes, strict=True):
        size, component = groups[i, h]
        if size:
            first.setdefault(component if (i, h) in groups else i, []).append((i, t))
    assert {(1, brute.texts()[0][1]), (7, None), (8, ""), (None, None)} <= kept
    assert not any(i in (2, 22) for i, _ in kept)


@pytest.mark.parametrize("run", [substring.dedup, suffixes.dedup, near.groups])
def test_empty_table(spark, run):
    assert run(brute.documents(spark, [])).count() == 0


def test_many_near_copies_are_one_component(spark):
    """A crowd of different copies: neighbours and hubs must connect it without all pairs."""
    base = brute.prose(50, 400).split()
    rows = []
    for k in range(700):
        own = list(base)
        own[(k * 7) % 390] = f"w{k}"
        rows.append((k, " ".join(own)))
    out = near.groups(brute.documents(spark, rows)).select(F.col("component.id").alias("c")).distinct().collect()
    assert [r.c for r in out] == [0]


def test_open_regions_are_compared_in_bounded_blocks(spark, monkeypatch):
    """Each pair of different components is in a unit, once; no unit holds the region."""
    monkeypatch.setattr(near, "BLOCK", 20)
    part = {k: 0 if k < 120 else k // 3 for k in range(300)}  # 120 members in the largest, 60 components of three
    region = [(b"r", k, 7, part[k], 0) for k in part] + [(b"s", k, 7, 1, 0) for k in range(50)] + [(b"t", k, 7, k, 0) for k in range(2)]
    units = {}
    for r in near.blocks(spark.createDataFrame(region, "region binary, id long, h long, cid long, ch long")).collect():
        assert (r.outside or not r.one) and (r.region[:1] == b"t" or r.outside == (r.cid != 0))
        units.setdefault(bytes(r.region), []).append(r)
    assert {u[:1] for u in units} == {b"r", b"t"} and [len(u) for k, u in units.items() if k[:1] == b"t"] == [2]
    assert max(map(len, units.values())) <= 4 * 20
    pairs = [
        (min(a.id, b.id), max(a.id, b.id))
        for name, u in units.items() if name[:1] == b"r"
        for a in u if a.one
        for b in u if b.two and a.cid != b.cid and not (b.outside and b.id < a.id)
    ]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in part for b in range(a + 1, 300) if part[a] != part[b]}


def test_crowded_regions_do_not_depend_on_neighbours(docs, hashes, monkeypatch):
    """Without any candidate, the exact comparison still finds all links of crowded regions, in small blocks."""
    monkeypatch.setattr(near, "CROWD", 1)
    monkeypatch.setattr(near, "BLOCK", 2)
    monkeypatch.setattr(near, "candidates", lambda batches: iter(()))
    out = near.groups(docs).select("id", "n_shingles", F.col("component.id").alias("c"))
    out = out.withColumns({c: F.when(F.col(c) != -(2**63), F.col(c)) for c in ("id", "c")})
    assert _rows(out, ["id", "n_shingles", "c"]) == _expected(brute.near(brute.texts(), hashes), hashes)


def test_spanning_forest_connects_similar_members():
    rng = np.random.default_rng(3)
    signature = rng.integers(0, 2**32, (1, near.HASHES), dtype=np.uint32).repeat(6, axis=0)
    for k in range(6):
        signature[k, k] += 1
    signature[5] = rng.integers(0, 2**32, near.HASHES, dtype=np.uint32)
    pairs = near.spanning(near.sketch(signature), np.full(6, 100))
    assert len(pairs) == 4 and 5 not in {x for p in pairs for x in p}


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    ruled_out = 0
    for n in (5, 60, 400, 9000):
        pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        sets = [np.unique(rng.choice(pool[: n + k], n, replace=False)) for k in range(0, n, max(1, n // 12))]
        bits = np.stack([np.frombuffer(near.bitmap(s), np.uint8) for s in sets])
        sizes = np.array([len(s) for s in sets])
        for i, one in enumerate(sets):
            may = near.may_link(bits, sizes, i, np.arange(len(sets)))
            for j, two in enumerate(sets):
                shared = len(np.intersect1d(one, two))
                linked = 100 * shared >= near.PERCENT * (len(one) + len(two) - shared)
                assert may[j] or not linked
                ruled_out += not may[j]
    assert ruled_out > 100


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    one, two = np.unique(pool[:2000]), np.unique(pool[1000:])
    s = near.minhash([one, two])
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.2


def test_super_kmers_cover_every_window_once():
    texts = pa.array([t or "" for _, t in brute.texts()])
    own = W.split(texts)
    document, pos, n, _ = substring.super_kmers(own)
    covered = sorted((d, p + j) for d, p, m in zip(document.tolist(), pos.tolist(), n.tolist(), strict=True) for j in range(m))
    assert covered == [(d, j) for d, c in enumerate(own.counts.tolist()) for j in range(c - substring.WINDOW + 1)]


def test_minima_by_segments(monkeypatch):
    data = np.random.default_rng(5).integers(0, 4, 5000).astype(np.uint8)
    whole = suffixes.minima(data, 200)
    monkeypatch.setattr(suffixes, "_SEGMENT", 333)
    cut = suffixes.minima(data, 200)
    # the order within a segment is that of the hash alone, so both name the same grams
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_words_split_on_the_six_blanks_only():
    texts = ["a\x0bb\x0cc\x1cd\x85e\xa0f  g ", " x\ty\r\nz", "", "   "]
    own = W.split(pa.array(texts))
    vocab = own.vocab.to_pylist()
    got = [[vocab[k] for k in own.ids[a:b]] for a, b in zip(own.offsets[:-1], own.offsets[1:], strict=True)]
    assert got == [brute.words(t) for t in texts]


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 13, 20])
def test_rolling_hash_is_the_window_alone(k):
    values = np.random.default_rng(6).integers(0, 3, 300).astype(np.uint64)
    hashes = W.rolling(W.mix64(values), k)
    assert len(hashes) == len(values) - k + 1
    seen: dict[bytes, int] = {}
    for j in range(len(hashes)):
        assert seen.setdefault(values[j : j + k].tobytes(), hashes[j]) == hashes[j]
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("w", [1, 2, 3, 7, 16])
def test_sliding_min_is_leftmost(w):
    values = np.random.default_rng(7).integers(0, 5, 200)
    got = W.sliding_min(values, w)
    assert got.tolist() == [i + int(np.argmin(values[i : i + w])) for i in range(len(values) - w + 1)]


def test_components(spark):
    rng = np.random.default_rng(8)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    up: dict[int, int] = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    out = components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "test"))
    assert {r.node: r.component for r in out.collect()} == {x: root(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


@pytest.mark.parametrize("module", [substring, suffixes])
def test_rows_that_share_an_id(spark, module):
    """Null and repeated ids: short rows beside long ones, one row to a partition; nothing is gathered for an id as a whole."""
    long, other = brute.prose(61, 400), brute.prose(62, 300)
    rows = [(None, long), (None, long[:150]), (None, long[:101]), (None, f"{other} {long}"), (None, "x"), (None, None)]
    rows += [(7, other), (7, other[:199]), (7, f"{long} {other}"), (7, ""), (2**60, long), (-3, other[:150])]
    df = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "k int, doc_id long, text string")
    hashes = [r.h for r in df.select("k", row_key()["h"].alias("h")).orderBy("k").collect()]
    plain = brute.substring if module is substring else brute.suffixes
    columns = ["n_words", "n_removed", "sha"] if module is substring else ["n_bytes", "n_removed", "n_spans", "sha"]
    found = plain(rows, hashes)
    out = module.dedup(df.drop("k").repartition(64)).withColumn("id", F.when(F.col("id") != -(2**63), F.col("id")))
    assert _rows(out, ["id", *columns]) == sorted(((i, *found[i, h]) for (i, _), h in zip(rows, hashes, strict=True)), key=repr)


def test_gathering_keys_spread_hot_ids(spark):
    from tidemark.llm.frames import gather_key

    rows = [(None, f"t{k}") for k in range(500)] + [(5, f"t{k}") for k in range(500)] + [(k, "same") for k in range(500)]
    keys = spark.createDataFrame(rows, "doc_id long, text string").select(row_key().alias("k")).select("k.*").select(gather_key().alias("g"))
    assert keys.distinct().count() >= 1490


def test_more_rounds_than_distances():
    """Windows beyond 400 batches: every distance is still looked at."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 101, 1200).astype(np.uint8).tobytes()
    before = suffixes._BATCH_WINDOWS
    suffixes._BATCH_WINDOWS = 2
    try:
        ends, equal = suffixes.equal_windows([data, data[100:1000]], np.array([500, 400]), np.array([0, 0]))
    finally:
        suffixes._BATCH_WINDOWS = before
    window = suffixes.WINDOW
    seen = {}
    for i, t in enumerate((data, data[100:1000])):
        for j in range(len(t) - window + 1):
            seen.setdefault(t[j : j + window], []).append((i, j))
    for i, t in enumerate((data, data[100:1000])):
        for j in range(len(t) - window + 1):
            at = (500, 400)[i]
            if 0 <= at - j <= window - suffixes.GRAM:
                assert equal[ends[i] + j] == (len(seen[t[j : j + window]]) > 1), (i, j)


@pytest.mark.parametrize("module", [substring, suffixes])
def test_small_partitions_share_files(spark, folder, monkeypatch, module):
    rows = _crowd(150)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(folder)
    docs, made = spark.read.parquet(folder), []

    class Seen(Scratch):
        def __init__(self, *args, **kwargs):
            super().__init__(*args, **kwargs)
            made.append(self)

    monkeypatch.setattr(module, "Scratch", Seen)
    monkeypatch.setattr(module, "CROWD", 10)
    columns = ["id", "n_removed", "sha"]
    plain = _rows(module.dedup(docs), columns)
    sizes = {"spark.sql.shuffle.partitions": "80", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in sizes}
    for name, value in sizes.items():
        spark.conf.set(name, value)
    try:
        many = _rows(module.dedup(docs), columns)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert many == plain and len({r[2] for r in many}) > 100
    files = {name: sum(f.endswith(".parquet") for f in os.listdir(path)) for name, path in made[-1].paths.items()}
    assert {"joined", "strings", "cut-strings"} <= set(files) and max(files.values()) <= 32
    # only what is small is put together, and an unknown size is not
    assert file_limit(docs) == 32 and file_limit(spark.createDataFrame(rows, docs.schema)) == 2**31 - 1


def test_scans_of_texts_hold_little_at_a_time():
    """Memory of a Python worker besides its batch does not follow the batch: 6 MB of texts, some of which all repeat."""

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    texts = [brute.prose(k % 40, 9000) for k in range(120)]
    ids = pa.array(range(120))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["id", "h", "text"])
    minis = pa.Table.from_batches(suffixes.minimisers(Rows())(iter([batch]))).to_pandas().groupby("id").mini.apply(list)
    shared = pa.array([minis.get(k, []) for k in range(120)], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts), shared], ["id", "h", "text", "shared"])
    for step in (suffixes.minimisers, suffixes.strings):
        tracemalloc.start()
        try:
            assert sum(out.num_rows for out in step(Rows())(iter([batch]))) > 0
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert peak < 120e6, (step.__name__, peak)
