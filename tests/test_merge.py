"""Merges against a row-at-a-time model, over many generated histories in one frame."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, merge

CHANGE = "case int, id string, v string, op string, ts bigint, seq bigint"
STATE = "case int, id string, v string"
KEYS, ORDER = ["case", "id"], ["ts", "seq"]


def model_net(target: dict, batch: list) -> dict:
    rows = dict(target)
    for key, v, op, *_ in sorted(batch, key=lambda c: c[3:]):
        rows.pop(key, None)
        if op != "D":
            rows[key] = v
    return rows


def model_phased(target: dict, batch: list) -> dict:
    last = {}
    for key, v, op, *_ in sorted(batch, key=lambda c: c[3:]):
        last[key, op] = v
    rows = dict(target)
    for (key, op), v in last.items():
        if op == "I" and key not in rows:
            rows[key] = v
    for (key, op), v in last.items():
        if op == "U" and key in rows:
            rows[key] = v
    for key, op in last:
        if op == "D":
            rows.pop(key, None)
    return rows


def histories(n: int, seed: int):
    """Targets and batches; values may be null, times collide so that ``seq`` decides."""
    rnd = random.Random(seed)
    targets, batches = {}, []
    for case in range(n):
        for i in rnd.sample("abcd", rnd.randint(0, 3)):
            targets[case, i] = rnd.choice(["old", None])
        for seq in range(rnd.randint(0, 8)):
            v = rnd.choice([f"v{seq}", None])
            batches.append(((case, rnd.choice("abcd")), v, rnd.choice("IUD"), rnd.randint(0, 3), seq))
    rnd.shuffle(batches)
    return targets, batches


def frames(spark, targets, batches):
    t = spark.createDataFrame([(c, i, v) for (c, i), v in targets.items()], STATE)
    b = spark.createDataFrame([(c, i, v, op, ts, seq) for (c, i), v, op, ts, seq in batches], CHANGE)
    return t, b


def collected(df) -> dict:
    rows = df.select("case", "id", "v").collect()
    found = {(r["case"], r["id"]): r["v"] for r in rows}
    assert len(found) == len(rows), "a key occurs twice"
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_net_equals_chronological_application(spark, seed):
    targets, batches = histories(300, seed)
    t, b = frames(spark, targets, batches)
    assert collected(merge.net(t, b, KEYS, ORDER)) == model_net(targets, batches)


@pytest.mark.parametrize("seed", [3, 4])
def test_phased_equals_three_phases(spark, seed):
    targets, batches = histories(300, seed)
    t, b = frames(spark, targets, batches)
    assert collected(merge.phased(t, b, KEYS, ORDER)) == model_phased(targets, batches)


def test_phased_equals_chained_single_merges(spark):
    targets, batches = histories(200, 5)
    t, b = frames(spark, targets, batches)
    ins, upd, dele = (changes.latest(part, KEYS, ORDER) for part in changes.split_by_op(b))
    chained = merge.merge_delete(merge.merge_update(merge.merge_insert(t, ins, KEYS), upd, KEYS), dele, KEYS)
    assert collected(chained) == collected(merge.phased(t, b, KEYS, ORDER))


def test_truth_tables(spark):
    """Every set of operations, target present or absent; for net the last one in time decides."""
    targets, batches, phased, net = {}, [], {}, {}
    combos = [c for n in range(4) for c in itertools.combinations("IUD", n)]
    for case, (present, ops) in enumerate(itertools.product([True, False], combos)):
        key = (case, "k")
        if present:
            targets[key] = "old"
        for n, op in enumerate(ops):
            batches.append((key, f"new{op}", op, n, n))
        after_insert = "old" if present else ("newI" if "I" in ops else None)
        after_update = "newU" if after_insert and "U" in ops else after_insert
        if after_update and "D" not in ops:
            phased[key] = after_update
        last = ops[-1] if ops else None
        if last in ("I", "U"):
            net[key] = f"new{last}"
        elif last is None and present:
            net[key] = "old"
    t, b = frames(spark, targets, batches)
    assert collected(merge.phased(t, b, KEYS, ORDER)) == phased
    assert collected(merge.net(t, b, KEYS, ORDER)) == net


def test_delete_then_insert_differs_between_modes(spark):
    t, b = frames(spark, {(0, "k"): "old"}, [((0, "k"), None, "D", 1, 1), ((0, "k"), "back", "I", 2, 2)])
    assert collected(merge.net(t, b, KEYS, ORDER)) == {(0, "k"): "back"}
    assert collected(merge.phased(t, b, KEYS, ORDER)) == {}


def test_update_to_null_replaces_the_value(spark):
    t, b = frames(spark, {(0, "k"): "old"}, [((0, "k"), None, "U", 1, 1)])
    assert collected(merge.net(t, b, KEYS, ORDER)) == {(0, "k"): None}
    assert collected(merge.phased(t, b, KEYS, ORDER)) == {(0, "k"): None}
    assert collected(merge.merge_update(t, b, KEYS)) == {(0, "k"): None}


def test_fold_does_not_depend_on_batch_order_and_may_repeat(spark):
    _, batches = histories(150, 6)
    expected = model_net({}, batches)
    empty = spark.createDataFrame([], CHANGE)
    rnd = random.Random(7)
    parts = [[], [], []]
    for c in batches:
        parts[rnd.randrange(3)].append(c)
    for order in itertools.islice(itertools.permutations(parts), 0, 6, 2):
        state = empty
        for part in (*order, order[0]):
            _, b = frames(spark, {}, part)
            state = merge.fold(state, changes.latest(b, KEYS, ORDER), KEYS, ORDER)
            state = spark.createDataFrame(state.collect(), state.schema)
        assert collected(merge.live(state, ORDER)) == expected


def test_net_of_two_batches_equals_net_of_their_union(spark):
    targets, batches = histories(200, 8)
    first = [c for c in batches if c[3] <= 1]
    second = [c for c in batches if c[3] > 1]
    t, b1 = frames(spark, targets, first)
    _, b2 = frames(spark, targets, second)
    stepwise = merge.net(merge.net(t, b1, KEYS, ORDER), b2, KEYS, ORDER)
    assert collected(stepwise) == collected(merge.net(t, b1.unionByName(b2), KEYS, ORDER))


def test_null_keys_match_nothing(spark):
    t = spark.createDataFrame([(None, "x", "old")], STATE)
    dele = spark.createDataFrame([(None, "x", None, "D", 1, 1)], CHANGE)
    assert merge.merge_delete(t, dele, KEYS).count() == 1


def test_merge_condition_names_every_key(spark):
    text = str(merge.match_condition(["a", "b"]))
    for part in ("target.a", "source.a", "target.b", "source.b"):
        assert part in text
    left = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int").alias("target")
    right = spark.createDataFrame([(1, 2)], "a int, b int").alias("source")
    assert left.join(right, merge.match_condition(["a", "b"])).count() == 1


def test_table_merge_needs_a_row_level_catalog(spark, folder):
    """Plain Parquet tables refuse MERGE; the adapter reaches Spark's own check."""
    spark.sql(f"create table plain_target (case int, id string, v string, ts bigint, seq bigint) using parquet location '{folder}'")
    try:
        b = spark.createDataFrame([(0, "k", "v", "I", 1, 1)], CHANGE)
        with pytest.raises(Exception, match="MERGE"):
            merge.merge_into_table(b, "plain_target", KEYS, ORDER)
    finally:
        spark.sql("drop table plain_target")


def test_ambiguous_and_duplicates(spark):
    _, b = frames(spark, {}, [((0, "k"), "a", "U", 1, 1), ((0, "k"), "a", "U", 1, 1), ((0, "k"), "b", "I", 2, 2)])
    assert [(r["op"], r["n"]) for r in changes.ambiguous(b, KEYS).collect()] == [("U", 2)]
    assert changes.dedupe(b, [*KEYS, *ORDER]).count() == 2


def test_operation_codes(spark):
    df = spark.createDataFrame([("u",), (" D ",), ("I",), ("x",), (None,)], "op string")
    got = [r[0] for r in df.select(changes.normal_op("op")).collect()]
    assert got == ["U", "D", "I", None, None]


def test_latest_takes_the_row_as_a_whole(spark):
    b = spark.createDataFrame([(0, "k", "v", "U", 1, 1), (0, "k", None, "U", 1, 2), (0, "k", "w", "U", None, 9)], CHANGE)
    row = changes.latest(b, KEYS, ORDER).collect()
    assert len(row) == 1 and row[0]["v"] is None and row[0]["seq"] == 2


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of all changes on one key: each map task sends on at most one of its rows."""
    n = 30000
    b = spark.range(0, n, 1, 8).select(
        F.lit(0).alias("case"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").alias("ts"),
    )
    net = changes.latest(b, ["case", "key"], ["ts"])
    assert net.filter("key = 'hot'").collect()[0]["ts"] == n - 3
    assert net.count() == n - n // 3 + 1
    plan = net._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max(struct") == 1 and plan.count("Exchange") == 1


def test_rows_of_one_instant_and_columns_that_cannot_be_compared(spark):
    b = spark.createDataFrame([(0, "k", v, "U", 1, 1) for v in ("a", "c", "b")], CHANGE)
    for n in (1, 3):
        assert changes.latest(b.repartition(n), KEYS, ORDER).first()["v"] == "c"
    maps = b.withColumn("m", F.create_map("v", "seq")).withColumn("seq", F.ascii("v").cast("bigint"))
    row = changes.latest(maps, KEYS, ORDER).collect()
    assert len(row) == 1 and row[0]["m"] == {"c": 1} and changes.latest(maps, KEYS, ORDER).columns == maps.columns
    # an order that names a key column
    assert changes.latest(b, KEYS, ["id", "ts", "seq"]).columns == b.columns


@pytest.mark.parametrize("maps", [False, True])
def test_ties_end_the_same_whatever_the_batches(spark, maps):
    """Equal order values: the rest of the row decides, in one batch and over several, in any order."""
    rows = [(0, k, v, op, 1, 1) for k in "abc" for v, op in (("x", "U"), ("z", "I"), ("y", "D"), (None, "U"))]
    b = spark.createDataFrame(rows, CHANGE)
    if maps:
        b = b.withColumn("m", F.create_map(F.lit("k"), F.coalesce("v", F.lit("-"))))
    once = {(r["id"]): r["v"] for r in changes.latest(b, KEYS, ORDER).collect()}
    for order in ([0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1, 2]):
        state = b.limit(0)
        for n in order:
            v = rows[n][2]
            part = b.filter(F.col("v").eqNullSafe(F.lit(v)))
            state = merge.fold(state, changes.latest(part, KEYS, ORDER), KEYS, ORDER)
            state = spark.createDataFrame(state.collect(), state.schema)
        assert {r["id"]: r["v"] for r in state.collect()} == once == {k: "z" for k in "abc"}


def test_names_that_need_quotes(spark):
    t = spark.createDataFrame([("1", "old")], "`the id` string, `a.b` string")
    b = spark.createDataFrame([("1", "new", "U", 1), ("2", "x", "I", 1)], "`the id` string, `a.b` string, op string, `t-s` long")
    for how in (merge.net, merge.phased):
        assert {tuple(r) for r in how(t, b, ["the id"], ["t-s"]).collect()} == {("1", "new"), ("2", "x")}
    state = changes.latest(b, ["the id"], ["t-s"])
    assert merge.fold(state, state, ["the id"], ["t-s"]).count() == 2
