"""Fetches of a feed folder: what is read, what is put, and what stays closed."""

from __future__ import annotations

import os
import time

import pytest

from tidemark.config import FeedConfig
from tidemark.operators import changes, deadletter
from tidemark.plans import deadletters, intake
from tidemark.plans.deadletters import Letters
from tidemark.sources import control, feed
from test_deadletter import down
from test_envelope import FLAT, event

CFG = FeedConfig(feed="f", row_schema=FLAT)


def put_file(folder, name, lines, age=3600):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")
    os.utime(f"{folder}/{name}", (time.time() - age,) * 2)


class Sink:
    def __init__(self):
        self.values = []

    def __call__(self, messages):
        self.values += [r["value"] for r in messages.collect()]


@pytest.fixture
def job(spark, folder):
    dead, sink = Letters(spark, f"{folder}/dead"), Sink()

    def fetch(publish=sink, margin_us=intake.MARGIN_US):
        return intake.fetch(spark, CFG, f"{folder}/feed", f"{folder}/control", dead, publish, margin_us)

    return fetch, dead, sink


def good(ts, key="1"):
    return event(key=f'{{"id":"{key}"}}', image=f'{{"id":"{key}","v":1.5}}', time=f'"ts_ms":{ts},')


def test_the_helper_makes_good_events(spark):
    from tidemark.operators import envelope

    rows = spark.createDataFrame([(good(5),)], "line string")
    assert envelope.classify(rows, CFG.keys, CFG.row_schema).first()["reason"] == "ok"


def test_an_unchanged_feed_is_not_read_again(spark, folder, job):
    fetch, dead, sink = job
    put_file(f"{folder}/feed", "a", [good(1), good(2), "{broken", ""])
    first = fetch()
    assert (first.files, first.read, first.published, first.quarantined) == (1, 4, 2, 1)
    for _ in range(2):
        again = fetch()
        assert (again.files, again.read) == (0, 0)
    assert len(sink.values) == 2 and dead.read().first()["puts"] == 1


def test_new_and_changed_files_are_read(spark, folder, job):
    fetch, dead, sink = job
    put_file(f"{folder}/feed", "a", [good(1), good(2)])
    fetch()
    put_file(f"{folder}/feed", "a", [good(1), good(2), good(3)], age=3500)
    put_file(f"{folder}/feed", "b", [good(4)], age=3650)  # late: older than the newest taken, within the margin
    got = fetch()
    assert got.files == 2 and got.published == 2 and len(sink.values) == 4
    put_file(f"{folder}/feed", "c", [good(9)], age=3500 + 700)  # beyond the margin
    assert fetch().files == 0


def test_files_before_the_margin_are_not_listed(spark, folder):
    for k in range(5):
        put_file(f"{folder}/feed", f"old{k}", [good(1)], age=90_000 + k)
    put_file(f"{folder}/feed", "new", [good(2)], age=10)
    listed = feed.files(spark, f"{folder}/feed", int((time.time() - 600) * 1e6)).collect()
    assert [os.path.basename(r["path"]) for r in listed] == ["new"] and listed[0]["bytes"] > 0
    plan = feed.files(spark, f"{folder}/feed")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_a_refused_line_is_put_once_and_stays_closed(spark, folder, job):
    """A malformed line has no time: it passes every mark, in every file that brings it."""
    fetch, dead, _ = job
    for k in range(3):
        put_file(f"{folder}/feed", f"f{k}", ["{broken", good(10 + k)], age=3600 - k)
        fetch()
    row = dead.read().first()
    assert dead.read().count() == 1 and row["puts"] == 1
    deadletters.purge(dead, f"{folder}/alerts")
    assert dead.read().count() == 0
    dead.compact()
    put_file(f"{folder}/feed", "g", ["{broken", "{other", good(20)], age=100)
    got = fetch()
    assert got.quarantined == 1 and [r["raw"] for r in dead.read().collect()] == ["{other"]


def test_refused_digests_can_be_forgotten(spark, folder, job):
    fetch, dead, _ = job
    put_file(f"{folder}/feed", "a", ["{broken"])
    fetch()
    control.forget_refused(spark, f"{folder}/control", int(time.time() * 1e6) + 10_000_000)
    assert control.read_refused(spark, f"{folder}/control").count() == 0
    put_file(f"{folder}/feed", "b", ["{broken"], age=10)
    fetch()
    assert dead.read().first()["puts"] == 2


def test_a_fetch_that_dies_is_done_again(spark, folder, job, monkeypatch):
    """It dies after the letters are put: the repeat replaces them, reads the files again and takes them once."""
    fetch, dead, sink = job
    put_file(f"{folder}/feed", "a", [good(1), "{broken"])
    append = control.append_refused
    monkeypatch.setattr(control, "append_refused", lambda *a: (_ for _ in ()).throw(ConnectionError("driver lost")))
    with pytest.raises(ConnectionError):
        fetch()
    monkeypatch.setattr(control, "append_refused", append)
    assert fetch().files == 1 and fetch().files == 0
    assert dead.read().first()["puts"] == 1


def test_an_outage_is_told_with_its_cause(spark, folder, job, caplog):
    fetch, dead, _ = job
    put_file(f"{folder}/feed", "a", [good(1)])
    got = fetch(down)
    assert not got.delivered and "ConnectionError" in got.error
    assert any("not delivered" in r.message for r in caplog.records)
    assert dead.read().first()["retriable"]


def test_repeats_move_digests_only(spark):
    rows = spark.createDataFrame([("a", "x" * 50, 0), ("b", "y", 1), ("a", "x" * 50, 2), ("a", "x" * 50, 3)], "digest string, line string, place long")
    found = changes.repeats(rows, "digest", "place")
    assert [tuple(r) for r in found.collect()] == [("a", 0)]
    kept = changes.without_repeats(rows, found, "digest", "place").collect()
    assert sorted(r["place"] for r in kept) == [0, 1]
    exchanges = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "line" in x]
    assert all("Aggregate" not in x for x in exchanges)


def test_purge_keeps_what_can_be_retried(spark, folder, job):
    fetch, dead, _ = job
    put_file(f"{folder}/feed", "a", [good(1), "{broken"])
    fetch(down)
    deadletters.purge(dead, f"{folder}/alerts")
    assert [r["reason"] for r in dead.read().collect()] == ["undelivered"]
    assert deadletter.state(dead.log()).count() == 1
