"""Targets that are read and merged without moving what the changes do not touch."""

from __future__ import annotations

import datetime
import glob
import os
import random

import pytest
from pyspark.sql import types as T

from tidemark.operators import changes
from tidemark.plans import folders, merging
from tidemark.plans.deadletters import Letters
from tidemark.sources import rawzone
from test_storage import CHANGE, change_rows, on_day, target_in, values

ROW = T.StructType().add("id", "string").add("region", "string").add("v", "string").add("op", "string").add("ts", "long")


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def by_region(spark, path, keys=("id",)):
    return folders.FolderTarget(spark, path, ROW, keys, ("ts",), "region")


def live(target):
    return {r["id"]: (r["region"], r["v"]) for r in target.rows().collect()}


def data_files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("keys", [("id",), ("id", "region")])
def test_a_batch_writes_the_folders_it_touches(spark, folder, keys):
    target = by_region(spark, folder, keys)
    first = [(f"{r}{k}", r, "a", "I", 1) for r in ("eu", "us", "as") for k in range(20)]
    folders.merge_changes(target, rows_of(spark, *first), "2024-01-01")
    before = data_files(folder)
    folders.merge_changes(target, rows_of(spark, ("eu3", "eu", "b", "U", 2), ("new", "eu", "c", "I", 2)), "2024-01-02")
    after = data_files(folder)
    assert all(after[f] == t for f, t in before.items())
    assert {f.split("_folder=")[1].split("/")[0] for f in set(after) - set(before)} == {"eu"}
    found = {r[folders.FOLDER]: (r["day"], r["n"]) for r in target.versions().collect()}
    assert found == {"eu": ("2024-01-02", 21), "us": ("2024-01-01", 20), "as": ("2024-01-01", 20)}
    assert live(target)["eu3"] == ("eu", "b") and len(live(target)) == 61
    read = target.state().inputFiles()
    assert all("batch=2024-01-01/_folder=eu" not in f for f in read)


def test_only_touched_folders_are_read_by_a_merge_on_their_key(spark, folder, monkeypatch):
    target = by_region(spark, folder, ("id", "region"))
    folders.merge_changes(target, rows_of(spark, *[(str(k), r, "a", "I", 1) for r in ("eu", "us") for k in range(5)]), "2024-01-01")
    asked, state = [], folders.FolderTarget.state

    def watch(self, before=None, folders=None):
        found = state(self, before, folders)
        asked.extend(found.inputFiles())
        return found

    monkeypatch.setattr(folders.FolderTarget, "state", watch)
    folders.merge_changes(target, rows_of(spark, ("1", "us", "b", "U", 2)), "2024-01-02")
    assert asked and all("_folder=us" in f for f in asked)


def test_rows_move_between_folders(spark, folder):
    target = by_region(spark, folder)
    folders.merge_changes(target, rows_of(spark, ("1", "eu", "a", "I", 1), ("2", "us", "a", "I", 1), ("3", None, "a", "I", 1)), "2024-01-01")
    folders.merge_changes(target, rows_of(spark, ("1", "us", "b", "U", 2), ("3", "a/b=c %", "b", "U", 2)), "2024-01-02")
    assert live(target) == {"1": ("us", "b"), "2": ("us", "a"), "3": ("a/b=c %", "b")}
    assert target.state().count() == 3
    empty = {r[folders.FOLDER]: r["n"] for r in target.versions().collect()}
    assert empty["eu"] == 0 and empty["null"] == 0
    folders.merge_changes(target, rows_of(spark, ("1", "eu", "old", "U", 1), ("2", None, None, "D", 3)), "2024-01-03")
    assert live(target) == {"1": ("us", "b"), "3": ("a/b=c %", "b")}, "an older change neither moves nor revives a row"


def test_random_batches_equal_the_last_change(spark, folder):
    rnd = random.Random(3)
    history = [(str(rnd.randrange(25)), rnd.choice(["eu", "us", "as", None]), f"v{t}", rnd.choice("IUUD"), t) for t in range(150)]
    last = {i: (region, v, op) for i, region, v, op, _ in history}
    rnd.shuffle(history)
    target = by_region(spark, folder)
    for n in (0, 2, 1, 1):  # the last day is repeated
        folders.merge_changes(target, rows_of(spark, *history[n::3]), f"2024-01-0{[0, 2, 1].index(n) + 1}")
    assert live(target) == {i: (region, v) for i, (region, v, op) in last.items() if op != "D"}
    assert target.state().count() == 25
    before = live(target)
    gone = folders.expire(target, 1)
    assert gone > 0 and live(target) == before and folders.expire(target, 1) == 0
    assert {f.split("batch=")[1][:10] for f in data_files(folder)} == {r["day"] for r in target.versions().filter("n > 0").collect()}
    folders.merge_changes(target, rows_of(spark, ("new", "eu", "x", "I", 999)), "2024-02-01")
    assert live(target) == {**before, "new": ("eu", "x")}


def test_a_run_that_dies_leaves_the_versions_before(spark, folder, monkeypatch):
    target = by_region(spark, folder)
    folders.merge_changes(target, rows_of(spark, ("1", "eu", "a", "I", 1)), "2024-01-01")
    append = folders.batches.append

    def dying(rows, path, batch=None):
        if path.endswith("versions"):
            raise ConnectionError("driver lost")
        return append(rows, path, batch)

    monkeypatch.setattr(folders.batches, "append", dying)
    with pytest.raises(ConnectionError):
        folders.merge_changes(target, rows_of(spark, ("1", "eu", "b", "U", 2)), "2024-01-02")
    monkeypatch.undo()
    assert live(target) == {"1": ("eu", "a")}
    folders.merge_changes(target, rows_of(spark, ("1", "eu", "b", "U", 2)), "2024-01-02")
    assert live(target) == {"1": ("eu", "b")}


def test_folders_take_text_days_and_keep_faulty_rows(spark, folder):
    raw, dead = f"{folder}/raw", Letters(spark, f"{folder}/dead")
    texts = spark.createDataFrame([("1", "eu", "a", "I", "1"), ("2", "us", "a", "I", "late")], "id string, region string, v string, op string, ts string")
    rawzone.write(on_day(texts), raw, "csv")
    target = by_region(spark, f"{folder}/target")
    for _ in range(2):
        folders.merge_day(target, raw, "2024-01-16", "csv", dead=dead)
    assert live(target) == {"1": ("eu", "a")}
    assert [(r["raw"], r["reason"], r["puts"]) for r in dead.read().collect()] == [("2,us,a,I,late", "malformed_row", 1)]


# ---------------------------------------------------------------- merge on read


def scans_below(df):
    """For every scan of the optimized physical plan (AQE's first), the operators above it up to the first join."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-*")) for x in plan]
    out = []
    for k, line in enumerate(plan):
        if "FileScan" not in line:
            continue
        above, at = [], depth[k]
        for j in range(k - 1, -1, -1):
            if depth[j] < at:
                at = depth[j]
                above.append(plan[j].strip(" :+-*"))
                if "Join" in plan[j]:
                    break
        out.append((line, above))
    return out


def test_reading_the_target_leaves_the_snapshot_where_it_is(spark, folder):
    target = target_in(spark, folder)
    merging.merge_changes(target, change_rows(spark, *[(str(i), "a", "I", 1) for i in range(500)]), "2024-01-01")
    target.add(change_rows(spark, ("3", "b", "U", 2), ("9", None, "D", 2), ("x", "c", "I", 2)), "s-1")
    # the changes are read from all their batches, the snapshot is one
    seen = [(scan, above) for scan, above in scans_below(target.rows()) if "batch#" not in scan]
    assert len(seen) == 2
    for _, above in seen:
        assert "BroadcastHashJoin" in above[-1] and not any("Exchange" in x for x in above), above
    got = values(target)
    assert len(got) == 500 and got["3"] == "b" and got["x"] == "c" and "9" not in got


def test_reading_agrees_with_and_without_a_broadcast(spark, folder):
    rnd = random.Random(8)
    target = target_in(spark, folder)
    history = [(str(rnd.randrange(40)), f"v{t}", rnd.choice("IUD"), t) for t in range(200)]
    merging.merge_changes(target, change_rows(spark, *history[::2]), "2024-01-01")
    target.add(change_rows(spark, *history[1::2]), "s-1")
    expected = {r["id"]: r["v"] for r in changes.latest(change_rows(spark, *history), ["id"], ["ts"]).filter("op <> 'D'").collect()}
    assert values(target) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert values(target) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "timestamp_ntz"])
def test_old_deletes_go_whatever_the_time_is_kept_in(spark, folder, kind):
    start = datetime.datetime(2024, 1, 1)
    schema = T.StructType([*CHANGE.fields[:-1]]).add("ts", T.LongType() if kind == "bigint" else T._parse_datatype_string(kind))

    def row(key, v, op, second):
        at = second * 1_000_000 if kind == "bigint" else start + datetime.timedelta(seconds=second)
        return key, v, op, at

    target = merging.Target(spark, folder, schema, ("id",), ("ts",))
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    merging.merge_changes(target, frame(row("1", None, "D", 1), row("2", None, "D", 50), row("3", "a", "I", 1)), "2024-01-01")
    merging.merge_changes(target, frame(row("4", "b", "I", 60)), "2024-01-02", keep_deletes_us=30_000_000)
    assert {r["id"] for r in target.state().collect()} == {"2", "3", "4"}


def test_snapshots_expire(spark, folder):
    target = target_in(spark, folder)
    for k in range(1, 6):
        merging.merge_changes(target, change_rows(spark, (str(k), "a", "I", k)), f"2024-01-0{k}")
    assert merging.expire_snapshots(target, 2) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert len(values(target)) == 5 and merging.expire_snapshots(target, 2) == []
    with pytest.raises(ValueError, match="newest"):
        merging.expire_snapshots(target, 0)
