"""Raw zone: text rows that do not fit, and compaction beside readers and streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures
from tidemark.plans import merging
from tidemark.plans.deadletters import Letters
from tidemark.sources import rawzone
from tidemark.streaming import jobs, progress
from test_storage import NASTY, SCHEMA, on_day, target_in, values
from test_streaming import CFG

DAY = "2024-01-15"
TYPED = T.StructType().add("id", "string").add("n", "integer").add("note", "string").add("ids", T.ArrayType(T.StringType()))
TEXTS = "id string, n string, note string, ids string"


def checked(spark, folder, fmt="csv"):
    return rawzone.read_checked(spark, folder, TYPED, "2024-01-16", fmt)


def test_rows_that_do_not_fit_come_back_as_text(spark, folder):
    rows = [("1", "5", "a\nb", '["x"]'), ("2", "oops", "c", '["y"]'), ("3", "6", 'say "q"', "[bad"), ("4", None, None, None), ("5", "99999999999", "", "[]")]
    rawzone.write(on_day(spark.createDataFrame(rows, TEXTS)), folder, "csv", "whole")
    rawzone.write(on_day(spark.createDataFrame([("6", "7")], "id string, n string")), folder, "csv", "short")
    rawzone.write(on_day(spark.createDataFrame([("7", "8", "n", "[]", "more")], f"{TEXTS}, more string")), folder, "csv", "long")
    good, faulty = rawzone.split(checked(spark, folder))
    assert {r["id"]: (r["n"], r["note"], r["ids"]) for r in good.collect()} == {"1": (5, "a\nb", ["x"]), "4": (None, None, None)}
    raws = sorted(r["raw"] for r in faulty.collect())
    assert [x[0] for x in raws] == ["2", "3", "5", "6", "7"] and "oops" in raws[0] and "[bad" in raws[1]
    assert good.count() == 2 and faulty.count() == 5, "counting reads every field"
    assert good.select("note").count() == 2
    everything = rawzone.read_checked(spark, folder, TYPED, fmt="csv", all_days=True)
    assert everything.filter(F.col(rawzone.FAULTY).isNotNull()).count() == 5


def test_what_one_task_reads_of_csv_is_bounded(spark, folder):
    """A CSV file is one task, so neither the rows of a file nor those of a task that writes grow with the table."""
    rows = spark.range(0, 50_000, numPartitions=1).select(F.col("id").cast("string"), F.lit(1).alias("n"), F.lit("x").alias("note"), F.lit("[]").alias("ids"))
    rawzone.write(on_day(rows), f"{folder}/raw", "csv", many_days=False)
    found = rawzone.read(spark, f"{folder}/raw", TYPED, "csv").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in found) == 50_000 and max(r["count"] for r in found) <= 20_000
    rows.repartition(5 * spark.sparkContext.defaultParallelism).write.parquet(f"{folder}/table")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        table = spark.read.parquet(f"{folder}/table")
        assert fixtures.dealt(table).rdd.getNumPartitions() >= table.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_plain_read_stops_at_such_a_row(spark, folder):
    rawzone.write(on_day(spark.createDataFrame([("2", "oops", "c", "[]")], TEXTS)), folder, "csv")
    with pytest.raises(Exception, match="oops|FAILFAST|MALFORMED"):
        rawzone.read_day(spark, folder, TYPED, "2024-01-16", "csv").collect()


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_good_rows_pass_a_checked_read_in_every_format(spark, folder, fmt):
    rawzone.write(on_day(spark.createDataFrame(NASTY, SCHEMA)), folder, fmt)
    rows = rawzone.read_checked(spark, folder, SCHEMA, "2024-01-16", fmt)
    good, faulty = rawzone.split(rows)
    assert {r["id"]: (r["note"], r["ids"]) for r in good.collect()} == {i: (note, ids) for i, note, ids in NASTY}
    assert faulty.count() == 0 and good.columns == ["id", "note", "ids", "ingest_date"]


def test_json_rows_that_do_not_fit(spark, folder):
    rawzone.write(on_day(spark.createDataFrame([("1", "x", "a", None)], TEXTS)), folder, "json")
    rawzone.write(on_day(spark.createDataFrame([("2", 3)], "id string, n int")), folder, "json")
    good, faulty = rawzone.split(checked(spark, folder, "json"))
    assert [r["id"] for r in good.collect()] == ["2"] and '"n":"x"' in faulty.first()["raw"]


def test_the_daily_merge_does_not_overwrite_good_values(spark, folder):
    raw, dead, target = f"{folder}/raw", Letters(spark, f"{folder}/dead"), target_in(spark, f"{folder}/target")
    texts = lambda *rows: spark.createDataFrame(list(rows), "id string, v string, op string, ts string")
    rawzone.write(on_day(texts(("1", "good", "I", "1"), ("2", "good", "I", "1")), "2024-01-14"), raw, "csv")
    rawzone.write(on_day(texts(("1", "better", "U", "2"), ("2", "lost", "U", "two"))), raw, "csv")
    merging.merge_day(target, raw, "2024-01-15", "csv", dead=dead)
    for _ in range(2):
        merging.merge_day(target, raw, "2024-01-16", "csv", dead=dead)
    assert values(target) == {"1": "better", "2": "good"}
    assert [(r["raw"], r["reason"], r["retriable"], r["puts"]) for r in dead.read().collect()] == [("2,lost,U,two", "malformed_row", False, 1)]


# ---------------------------------------------------------------- compaction


def ids(df):
    return sorted(r["id"] for r in df.collect())


def batch(spark, a, b):
    return spark.createDataFrame([(str(i).zfill(3), "n", ["x"]) for i in range(a, b)], SCHEMA)


def read_day(spark, folder):
    return rawzone.read_day(spark, folder, SCHEMA, "2024-01-16")


def data_files(df):
    return {r["f"] for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_compacted_day_reads_the_same(spark, folder, fmt):
    for k in range(8):
        rawzone.write(on_day(batch(spark, 10 * k, 10 * k + 10)), folder, fmt, f"b-{k}")
    rawzone.write(on_day(batch(spark, 900, 905), "2024-01-16"), folder, fmt, "b-9")
    day = lambda: rawzone.read_day(spark, folder, SCHEMA, "2024-01-16", fmt)
    whole = lambda: rawzone.read(spark, folder, SCHEMA, fmt)
    before, all_before = ids(day()), ids(whole())
    assert rawzone.compact(spark, folder, DAY, SCHEMA, fmt) == 8
    assert ids(day()) == before and ids(whole()) == all_before and len(data_files(day())) == 1
    assert rawzone.compact(spark, folder, DAY, SCHEMA, fmt) == 0
    rawzone.write(on_day(batch(spark, 80, 85)), folder, fmt, "late")
    assert len(ids(day())) == 85 and len(ids(whole())) == 90
    assert rawzone.compact(spark, folder, DAY, SCHEMA, fmt) == 1 and len(ids(day())) == 85
    assert rawzone.drop_compacted(spark, folder, DAY) == 9
    assert len(ids(day())) == 85 and len(ids(whole())) == 90 and len(data_files(day())) == 1
    rawzone.write(on_day(batch(spark, 85, 87)), folder, fmt, "later")
    assert len(ids(day())) == 87 and rawzone.compact(spark, folder, DAY, SCHEMA, fmt) == 1 and len(ids(day())) == 87


def test_files_follow_the_size(spark, folder):
    for k in range(6):
        rawzone.write(on_day(batch(spark, 1000 * k, 1000 * k + 1000)), folder, batch=f"b-{k}")
    size = sum(__import__("os").path.getsize(f.removeprefix("file://")) for f in data_files(read_day(spark, folder)))
    rawzone.compact(spark, folder, DAY, SCHEMA, file_bytes=size // 3)
    assert len(data_files(read_day(spark, folder))) in (3, 4) and read_day(spark, folder).count() == 6000
    plan = read_day(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_stream_reads_every_batch_once(spark, folder):
    """Compaction before, between and after its micro-batches adds no row to a stream."""
    out, state = f"{folder}-out", f"{folder}-state"

    def drain():
        rows = rawzone.stream(spark, folder, SCHEMA, max_files=1)
        jobs.start(rows, lambda b, n: progress.write_batch(b, n, out), CFG, state, drain=True).awaitTermination()

    for k in range(3):
        rawzone.write(on_day(batch(spark, 10 * k, 10 * k + 10)), folder, batch=f"b-{k}")
        if k == 1:
            rawzone.compact(spark, folder, DAY, SCHEMA)
        drain()
    rawzone.compact(spark, folder, DAY, SCHEMA)
    drain()
    rawzone.drop_compacted(spark, folder, DAY)
    rawzone.write(on_day(batch(spark, 30, 33)), folder, batch="b-3")
    drain()
    assert ids(spark.read.parquet(out)) == [str(i).zfill(3) for i in range(33)]
    assert ids(read_day(spark, folder)) == [str(i).zfill(3) for i in range(33)]


def test_a_compaction_that_dies_changes_nothing(spark, folder, monkeypatch):
    rawzone.write(on_day(batch(spark, 0, 10)), folder, batch="b-0")

    def lost(*a):
        raise ConnectionError("driver lost")

    monkeypatch.setattr(rawzone.batches, "append", lost)
    with pytest.raises(ConnectionError):
        rawzone.compact(spark, folder, DAY, SCHEMA)
    monkeypatch.undo()
    assert read_day(spark, folder).count() == 10 and rawzone.drop_compacted(spark, folder, DAY) == 0
    assert rawzone.compact(spark, folder, DAY, SCHEMA) == 1 and read_day(spark, folder).count() == 10
    assert rawzone.compact(spark, folder, "2024-03-01", SCHEMA) == 0
