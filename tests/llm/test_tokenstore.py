"""The token store: exact round trips, order, indexes and pruned reads."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

import brute
from tidemark.llm import packing, tokenstore


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_path())


def _expected(rows, tokenizer):
    """(id, start, n_tokens, crc) of rows in order; rows of one id by a hash are left to the caller."""
    at, out = 0, []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def _files(path):
    import glob

    return sorted(glob.glob(f"{path}/ids/*.orc"))


def test_round_trip(spark, folder, tokenizer):
    docs = brute.documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"]).repartition(3)
    tokenstore.write(docs, folder, packing.default_path())
    got = [tuple(r) for r in tokenstore.checksums(tokenstore.read(spark, folder)).orderBy("start").collect()]
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert got == _expected(sorted(rows, key=lambda x: x[0]), tokenizer)


def test_ids_come_back(spark, folder, tokenizer):
    docs = brute.documents(spark, [(3, "Hello, wörld!"), (1, None), (2, "")])
    tokenstore.write(docs, folder, packing.default_path(), end_id=7)
    got = {r.doc_id: r.ids for r in tokenstore.read(spark, folder).collect()}
    assert got == {3: [*tokenizer.encode("Hello, wörld!", add_special_tokens=False).ids, 7], 1: [7], 2: [7]}


def test_repeated_and_null_ids(spark, folder, tokenizer):
    """The store does not depend on how the input is cut; null ids come first, every row is stored."""
    rows = [(None, "a b"), (None, "c"), (4, "x y z"), (4, "x y z"), (4, "other words"), (4, None), (2, "q")]
    found = []
    for n, path in ((1, f"{folder}-a"), (5, f"{folder}-b")):
        tokenstore.write(brute.documents(spark, rows).repartition(n), path, packing.default_path())
        found.append([tuple(r) for r in tokenstore.checksums(tokenstore.read(spark, path)).orderBy("start").collect()])
    assert found[0] == found[1]
    assert [r[0] for r in found[0]] == [None, None, 2, 4, 4, 4, 4]
    plain = sorted(x[2:] for x in _expected(rows, tokenizer))
    assert sorted(x[2:] for x in found[0]) == plain
    starts = np.cumsum([0, *(x[2] for x in found[0])])
    assert [x[1] for x in found[0]] == starts[:-1].tolist()


def test_hot_id_is_dealt_out(spark, folder):
    """A third of all rows have one id: they spread over files by hash and place."""
    rows = [(5 if k % 3 == 0 else k, f"text {k if k % 2 else 0}") for k in range(3000)]
    tokenstore.write(brute.documents(spark, rows).repartition(4), folder, packing.default_path())
    sizes = [orc.ORCFile(f).nrows for f in _files(folder)]
    assert sum(sizes) == 3000 and max(sizes) < 1500


def test_empty_table(spark, folder):
    tokenstore.write(brute.documents(spark, []), folder, packing.default_path())
    assert tokenstore.checksums(tokenstore.read(spark, folder)).collect() == []


def test_stripes_indexes_and_bloom_filters(spark, folder):
    """Files have several stripes, an index entry per stride, and Bloom filters that know the ids."""
    rows = [(2 * k, brute.prose(k % 50, 60)) for k in range(12_000)]
    tokenstore.write(brute.documents(spark, rows), folder, packing.default_path(), stripe_bytes=1 << 16, stride=1000)
    assert max(orc.ORCFile(f).nstripes for f in _files(folder)) > 1
    jvm = spark._jvm
    file = max(_files(folder), key=lambda f: orc.ORCFile(f).nrows)
    reader = jvm.org.apache.orc.OrcFile.createReader(
        jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
    )
    assert reader.getRowIndexStride() == 1000
    column = list(reader.getSchema().getFieldNames()).index("doc_id") + 1
    wanted = spark.sparkContext._gateway.new_array(jvm.boolean, reader.getSchema().getMaximumId() + 1)
    wanted[column] = True
    index = reader.rows().readRowIndex(0, wanted, wanted)
    blooms = index.getBloomFilterIndex()[column]
    kind = index.getBloomFilterKinds()[column]
    assert blooms is not None and kind is not None and blooms.getBloomFilterCount() >= 1
    entries = index.getRowGroupIndex()[column]
    assert entries.getEntryCount() == blooms.getBloomFilterCount()


def test_lookups_are_pushed_down(spark, folder):
    docs = brute.documents(spark, [(k, f"words of text {k}") for k in range(2000)])
    tokenstore.write(docs, folder, packing.default_path())
    found = tokenstore.read(spark, folder, [17, 1999, -4])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(doc_id" in plan
    whole = {r.doc_id: tuple(r) for r in tokenstore.read(spark, folder).collect()}
    assert sorted(tuple(r) for r in found.collect()) == [whole[17], whole[1999]]


def test_stripe_parallel_reads_agree(spark, folder):
    """Small splits read each stripe in a task of its own and still know every start."""
    rows = [(k, brute.prose(k % 40, 80)) for k in range(6000)]
    tokenstore.write(brute.documents(spark, rows).repartition(2), folder, packing.default_path(), stripe_bytes=1 << 16)
    whole = sorted(tuple(r) for r in tokenstore.checksums(tokenstore.read(spark, folder)).collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        cut = tokenstore.checksums(tokenstore.read(spark, folder))
        assert cut.rdd.getNumPartitions() > len(_files(folder))
        assert sorted(tuple(r) for r in cut.collect()) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
