"""Hard negatives against scoring every pair."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives


def _expected(rows, every=10):
    """rows: (place, id, vector, label), in the order in which ties are broken."""
    usable = [
        (p, i, [math.floor(256 * float(x)) for x in v], lab)
        for p, i, v, lab in rows
        if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    low, out = -(2**63), []
    for p, i, v, lab in usable:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, q, other) for q, j, w, other in usable if q != p and len(w) == len(v)]
        scored.sort(key=lambda x: (-x[0], low if x[1] is None else x[1], x[2]))
        for ps, pid, *_ in [x for x in scored if x[3] == lab][:5]:
            near = [x for x in scored if x[3] != lab and 30 * ps <= 100 * x[0] <= 90 * ps][:10]
            out += [(i, pid, k, x[1], ps, x[0]) for k, x in enumerate(near, 1)]
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=repr)


def _rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    out = centres[rng.integers(0, 6, n)] + 0.7 * rng.normal(size=(n, dim))
    out /= np.linalg.norm(out, axis=1)[:, None]
    return [(int(i), v.tolist(), int(lab)) for i, v, lab in zip(rng.permutation(n), out.astype(np.float32).astype(float), rng.integers(0, 4, n), strict=True)]


SCHEMA = "vec_id long, embedding array<float>, label int, place string, id string, dim string, shard string, score string"


def _frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA.replace("array<float>", f"array<{kind}>")).coalesce(1)


@pytest.mark.parametrize("block_bytes, spread_rows", [(32 << 20, 4096), (6000, 40)])
def test_against_all_pairs(spark, block_bytes, spread_rows):
    rows = _rows(400, 20, 1)
    got = negatives.mine(_frame(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=block_bytes, spread_rows=spread_rows)
    assert _got(got) == _expected([(p, *r) for p, r in enumerate(rows)])


def test_nulls_ties_and_lengths(spark):
    """Repeated and null ids, equal vectors, unusable rows, vectors of several lengths, negative scores."""
    nan, inf = float("nan"), float("inf")
    rows = _rows(120, 6, 2)
    rows += [(10, [1.0] * 6, 1)] * 3 + [(10, [1.0] * 6, 2)] * 12 + [(None, [1.0] * 6, 1), (None, [0.5] * 6, 2), (None, None, None)]
    rows += [(20, None, 1), (30, [1.0, None] * 3, 1), (40, [nan] * 6, 2), (50, [inf] * 6, 1), (60, [1.0] * 6, None)]
    rows += [(70, [], 1), (71, [], 1), (72, [], 2), (80, [-1.0, 2.0], 1), (81, [1.0, -2.0], 1), (82, [-0.5, 1.0], 3), (90, [1.0], 1), (100, [0.001] * 6, 1)]
    got = negatives.mine(_frame(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=900, spread_rows=50)
    assert _got(got) == _expected([(p, *r) for p, r in enumerate(rows)])


def test_hot_label(spark):
    """One label with most rows, and an anchor without any other row of its own."""
    rows = [(i, v, 0 if i % 3 else 1) for i, v, _ in _rows(300, 8, 3)] + [(500, [1.0] * 8, 9)]
    got = negatives.mine(_frame(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=3000)
    assert _got(got) == _expected([(p, *r) for p, r in enumerate(rows)])


def test_large_components(spark):
    """Beyond 2**53 sums are in integers and exact; beyond 64 bits they are refused."""
    big = float(2**22)
    rows = [(0, [big, 1.0, big], 1), (1, [big, 3.0, big], 1), (2, [big, 2.0, big / 2], 2), (3, [big, 1.0, big / 2], 2), (10, [1.0, 0.0, 0.0], 2)]
    got = negatives.mine(_frame(spark, rows, "double"), F.col("vec_id") % 10 == 0)
    assert _got(got) == _expected([(p, *r) for p, r in enumerate(rows)])
    with pytest.raises(Exception, match="do not fit 64 bits"):
        negatives.mine(_frame(spark, [*rows, (20, [1e200, 0.0, 0.0], 1)], "double"), F.col("vec_id") % 10 == 0).collect()


def test_empty(spark):
    assert negatives.mine(_frame(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    assert negatives.mine(_frame(spark, _rows(9, 4, 4)), F.lit(False)).collect() == []


def test_bounds_shrink_the_candidates():
    """A clustered shard is decided before all columns are read, and nothing is lost by it."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    weight = 1.0 / (1 + np.arange(64))
    vectors = rng.normal(size=(3000, 64)) * weight
    labels = rng.integers(0, 3, 3000)
    table = pa.table({"id": np.arange(3000), "label": labels, "place": np.arange(3000), "vector": pa.array(vectors.tolist(), pa.list_(pa.float64()))})
    anchor = np.floor(256 * vectors[0])
    shard = negatives.Shard(table, 64, 256, anchor[None])
    left = []

    def watch(prune):
        return lambda scores, low, high: left.append(int((keep := prune(scores, low, high)).sum())) or keep

    rows, scores = shard.scan(anchor, np.arange(3000), (0, 3000), watch(negatives._best(5)))
    exact = (np.floor(256 * vectors) @ anchor).astype(np.int64)
    assert sorted(scores.tolist(), reverse=True)[:5] == sorted(exact.tolist(), reverse=True)[:5]
    assert left[-1] < 300 and left == sorted(left, reverse=True)


def test_window_edges():
    for score in range(-50, 200):
        own = [s for s in range(-100, 300) if 30 * score <= 100 * s <= 90 * score]
        least, most = negatives.window(score)
        assert own == list(range(least, most + 1))
