"""Raw zone, control table, batches and the target."""

from __future__ import annotations

import datetime
import glob
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session
from tidemark.operators import deadletter, watermark
from tidemark.plans import merging
from tidemark.plans.deadletters import Letters
from tidemark.sources import batches, control, rawzone

SCHEMA = (
    T.StructType().add("id", "string").add("note", "string").add("ids", T.ArrayType(T.StringType()))
)
NASTY = [
    ("0001", 'say "hi", \\ and\nnew\r\nline', ['a,"b', "c\nd", None]),
    ("0002", "", []),
    ("0003", None, None),
    ("0004", "  padded  ", [" x "]),
    ("0005", "null", ["null"]),
    ("0006", '"', ['"']),
]


def on_day(df, day="2024-01-15"):
    return df.withColumn(rawzone.DAY, F.to_date(F.lit(day)))


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_raw_zone_gives_back_what_it_got(spark, folder, fmt):
    rawzone.write(on_day(spark.createDataFrame(NASTY, SCHEMA)), folder, fmt)
    back = rawzone.read(spark, folder, SCHEMA, fmt)
    assert back.columns == ["id", "note", "ids", "ingest_date"]
    got = {r["id"]: (r["note"], r["ids"]) for r in back.collect()}
    assert got == {i: (note, ids) for i, note, ids in NASTY}


def test_batches_add_up_and_a_repeated_batch_does_not(spark, folder):
    df = spark.createDataFrame(NASTY, SCHEMA)
    rawzone.write(on_day(df), folder)
    rawzone.write(on_day(df), folder)
    assert rawzone.read(spark, folder, SCHEMA).count() == 2 * len(NASTY)
    for _ in range(2):
        rawzone.write(on_day(df, "2024-01-16"), folder, batch="landing-7")
    counts = {r["ingest_date"].isoformat(): r["n"] for r in rawzone.day_counts(rawzone.read(spark, folder, SCHEMA)).collect()}
    assert counts == {"2024-01-15": 2 * len(NASTY), "2024-01-16": len(NASTY)}


def test_previous_day_is_read_by_its_folder(spark, folder):
    df = spark.createDataFrame(NASTY, SCHEMA)
    for day in ("2024-02-28", "2024-02-29", "2024-03-01"):
        rawzone.write(on_day(df, day), folder)
    day = rawzone.read_day(spark, folder, SCHEMA, run_date="2024-03-01")
    assert {r["ingest_date"] for r in day.collect()} == {datetime.date(2024, 2, 29)}
    assert all("ingest_date=2024-02-29/" in f for f in day.inputFiles())
    none = rawzone.read_day(spark, folder, SCHEMA, run_date="2024-03-09")
    assert none.count() == 0 and none.columns == day.columns
    assert rawzone.read_day(spark, folder, SCHEMA).count() == 0


def test_marks_never_go_back_and_feeds_do_not_meet(spark, folder):
    assert control.read(spark, folder).count() == 0
    assert watermark.mark_of(control.read(spark, folder), "f") == 0

    def fetch(*seen):
        control.append(spark.createDataFrame(list(seen), watermark.CONTROL_SCHEMA), folder)
        return {r["feed_name"]: r["last_upd"] for r in watermark.marks(control.read(spark, folder)).collect()}

    assert fetch(("f", 10), ("f", 12), ("g", 5)) == {"f": 12, "g": 5}
    assert fetch() == {"f": 12, "g": 5}
    assert fetch(("f", 11), ("g", None)) == {"f": 12, "g": 5}
    assert fetch(("f", 13)) == {"f": 13, "g": 5}


def test_batches(spark, folder):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert batches.read(spark, folder, "x int").count() == 0 and batches.names(spark, folder) == []
    assert batches.latest_name(spark, folder) is None
    batches.append(df, folder, "b")
    batches.append(df, folder, "b")
    batches.append(df, folder, "a")
    assert batches.read(spark, folder, "x int").count() == 4 and batches.names(spark, folder) == ["a", "b"]
    assert batches.latest_name(spark, folder) == "b" and batches.latest_name(spark, folder, before="b") == "a"
    kept = batches.read(spark, folder, "x int").distinct()
    batches.rewrite(kept, folder, ["a", "b"])
    assert sorted(r["x"] for r in batches.read(spark, folder, "x int").collect()) == [1, 2]


def folder_names(folder):
    return sorted(f.split("batch=")[1] for f in glob.glob(f"{folder}/batch=*"))


def test_a_reader_that_has_begun_can_finish(spark, folder):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    for b in "ab":
        batches.append(df, folder, b)
    begun = batches.read(spark, folder, "x int")
    first = batches.rewrite(begun.distinct(), folder, ["a", "b"])
    assert begun.count() == 4, "what it has listed is still there"
    assert batches.names(spark, folder) == [first] and folder_names(folder) == sorted(["a", "b", first])
    batches.append(df, folder, "c")
    second = batches.rewrite(batches.read(spark, folder, "x int"), folder, [first, "c"])
    assert batches.names(spark, folder) == [second] and folder_names(folder) == sorted(["c", first, second])
    assert batches.read(spark, folder, "x int").count() == 4


def test_a_rewrite_that_dies_counts_for_nothing(spark, folder, monkeypatch):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    batches.append(df, folder, "a")
    append = batches.append

    def dying(rows, path, batch=None):
        if path.endswith("_rewrites"):
            raise ConnectionError("driver lost")
        return append(rows, path, batch)

    monkeypatch.setattr(batches, "append", dying)
    with pytest.raises(ConnectionError):
        batches.rewrite(df, folder, ["a"])
    monkeypatch.undo()
    assert batches.names(spark, folder) == ["a"] and batches.read(spark, folder, "x int").count() == 2
    name = batches.rewrite(df, folder, ["a"])
    assert batches.read(spark, folder, "x int").count() == 2 and folder_names(folder) == sorted(["a", name])


def test_puts_are_not_doubled_while_letters_are_rewritten(spark, folder, monkeypatch):
    dead = Letters(spark, folder)
    rows = spark.createDataFrame([("r",)], "raw string")
    for k in range(3):
        dead.put(deadletter.puts(rows, "raw", deadletter.message_key("raw"), F.lit("undelivered")), f"b-{k}")
    monkeypatch.setattr(batches, "remove", lambda *a: (_ for _ in ()).throw(ConnectionError("driver lost")))
    with pytest.raises(ConnectionError):
        dead.compact()
    assert dead.read().first()["puts"] == 3


CHANGE = T.StructType().add("id", "string").add("v", "string").add("op", "string").add("ts", "long")


def change_rows(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def target_in(spark, path, order=("ts",)):
    return merging.Target(spark, path, CHANGE, ("id",), order)


def values(target):
    return {r["id"]: r["v"] for r in target.rows().collect()}


def test_snapshots_follow_one_another(spark, folder):
    target = target_in(spark, folder)
    merging.merge_changes(target, change_rows(spark, *[(str(i), "a", "I", 1) for i in range(5)]), "2024-01-01")
    for _ in range(2):  # a repeated run does the same again
        merging.merge_changes(target, change_rows(spark, ("3", "b", "U", 2), ("9", None, "D", 2), ("4", None, "D", 2)), "2024-01-02")
    assert values(target) == {"0": "a", "1": "a", "2": "a", "3": "b"}
    merging.merge_changes(target, change_rows(spark, ("4", "old", "U", 1)), "2024-01-03")
    assert values(target) == {"0": "a", "1": "a", "2": "a", "3": "b"}, "an old change does not bring a key back"
    merging.merge_changes(target, change_rows(spark, ("0", "z", "U", 9)), "2024-01-04", keep_deletes_us=5)
    assert target.state().filter("op = 'D'").count() == 0 and values(target)["0"] == "z"


def test_a_run_that_dies_leaves_the_snapshot_before(spark, folder, monkeypatch):
    target = target_in(spark, folder)
    merging.merge_changes(target, change_rows(spark, ("1", "a", "I", 1)), "2024-01-01")

    def lost(*args):
        raise ConnectionError("driver lost")

    monkeypatch.setattr(merging.Target, "store", lost)
    with pytest.raises(ConnectionError):
        merging.merge_changes(target, change_rows(spark, ("1", "b", "U", 2)), "2024-01-02")
    monkeypatch.undo()
    assert values(target) == {"1": "a"}


def test_batches_of_a_stream_read_like_one_merge(spark, folder):
    """Random batches, out of order and repeated, with a rewrite in between."""
    rnd = random.Random(5)
    history = [(str(rnd.randrange(20)), f"v{t}", rnd.choice("IUD"), t) for t in range(120)]
    last = {}
    for i, v, op, t in history:
        last[i] = (v, op)
    expected = {i: v for i, (v, op) in last.items() if op != "D"}
    rnd.shuffle(history)
    target = target_in(spark, folder)
    for n in (0, 1, 2, 1, 3):
        target.add(change_rows(spark, *history[n::4]), f"batch-{n}")
        if n == 2:
            merging.compact(target, "2024-01-01")
            assert target.changes().count() == 0
    assert values(target) == expected and target.state().count() == 20
    merging.compact(target, "2024-01-02")
    assert values(target) == expected
    with pytest.raises(ValueError, match="already"):
        merging.compact(target, "2024-01-02")


def test_phased_mode_remembers_deletes(spark, folder):
    target = target_in(spark, folder)
    merging.merge_changes(target, change_rows(spark, ("1", None, "D", 5), ("2", "a", "I", 1)), "2024-01-01")
    merging.merge_changes(target, change_rows(spark, ("2", None, "D", 6), ("3", "c", "I", 6)), "2024-01-02", merging.PHASED)
    assert values(target) == {"3": "c"}
    merging.merge_changes(target, change_rows(spark, ("1", "old", "U", 4), ("2", "old", "U", 2)), "2024-01-03")
    assert values(target) == {"3": "c"}
    with pytest.raises(ValueError, match="unknown"):
        merging.merge_changes(target, change_rows(spark), "2024-01-04", "other")


def test_merge_job_reads_yesterday(spark, folder):
    raw = f"{folder}/raw"
    for day, v in (("2024-01-14", "a"), ("2024-01-15", "b"), ("2024-01-16", "c")):
        rawzone.write(on_day(change_rows(spark, ("0001", v, "U", 1), (v, v, "I", 1)), day), raw)
    target = target_in(spark, f"{folder}/target")
    merging.merge_day(target, raw, "2024-01-16")
    assert values(target) == {"0001": "b", "b": "b"}


class FakeSession:
    """A session without the shared folder setting."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})()


def test_own_folder_only_on_a_local_master():
    local = FakeSession("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("yarn"))


def test_shared_folder_comes_from_the_session(spark):
    assert session.fresh_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_shuffle_partitions_follow_the_data():
    assert session.shuffle_partitions(0, 8) == 8
    assert session.shuffle_partitions(100 * 2**40, 4000) == 100 * 2**40 // (128 * 2**20)


def test_old_work_folders_go(spark):
    kept, gone, other = (session.fresh_dir(spark, label) for label in ("expire-me", "expire-me", "other-label"))
    for path in (kept, gone, other):
        spark.range(1).write.parquet(f"{path}/table")
    long_ago = 1_600_000_000
    for path in (gone, other):
        for where in (path, f"{path}/table"):
            os.utime(where, (long_ago, long_ago))
    assert session.expire_work(spark, 3600, "expire-me") == [gone.rsplit("/", 1)[1]]
    assert os.path.isdir(kept) and os.path.isdir(other) and not os.path.exists(gone)
