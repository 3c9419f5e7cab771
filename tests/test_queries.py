"""Every registered query against its SQL, and what its plan must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import compare
from checks import fixtures as X
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tidemark.operators import changes, merge
from tidemark.plans import intake
from tidemark.streaming import jobs

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.database(DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, con, name):
    assert compare.difference(spark, con, name, DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == X.SLOT_ROW and df.count() > 0


# queries that start jobs of their own when called; their operators are covered by the others
_JOBS = {
    "replay_guard", "dlq_purge", "dlq_replay", "dlq_failover", "dlq_outage", "intake_run", "merge_day", "registry_stored",
    "commit_progress", "stream_raw_ingest", "stream_merge", "intake_fetch", "merge_folders", "merge_folders_touched", "merge_restart",
    "landing_restart", "raw_compaction", "raw_csv_quarantine", "stream_dedupe", "delivery_log", "landing_accounts",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in _JOBS])
def test_plan_stays_in_the_jvm_and_joins_on_keys(spark, name):
    plan = plan_of(QUERIES[name](spark, DIR))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


def test_net_merge_reads_key_columns_only_for_the_removal(spark):
    schemas = re.findall(r"ReadSchema: (\S+)", plan_of(merge.net(X.target(spark, DIR), X.batch(spark, DIR), X.SLOT_KEYS, X.ORDER)))
    assert "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in schemas and len(schemas) == 3


def test_time_filters_reach_the_scan(spark):
    for name in ("incremental_scan", "merge_net", "merge_phased"):
        assert "PushedFilters: [IsNotNull(ts), " in plan_of(QUERIES[name](spark, DIR))


def test_drift_of_all_levels_reads_the_images_once(spark):
    plan = plan_of(QUERIES["schema_drift_nested"](spark, DIR))
    assert plan.count("FileScan parquet") == 1 and plan.count("Generate explode") == 1


def test_day_scan_lists_one_folder(spark):
    files = QUERIES["raw_day_scan"](spark, DIR).inputFiles()
    assert files and all("ingest_date=2024-01-15/" in f for f in files)


def test_phased_merge_reads_each_side_once(spark):
    plan = plan_of(QUERIES["merge_phased"](spark, DIR))
    assert plan.count("FileScan parquet") == 2 and plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_every_cell_of_the_truth_table_occurs(spark, sf):
    """Target there or not, and every set of operations, none included: else a broken merge could pass."""
    d = f"/root/testdata/sf{sf}"
    ops = X.batch(spark, d).groupBy(*X.SLOT_KEYS).agg(F.array_join(F.array_sort(F.collect_set("op")), "").alias("ops"))
    target = X.target(spark, d).select(*X.SLOT_KEYS, F.lit(True).alias("there"))
    cells = target.join(ops, X.SLOT_KEYS, "full").select(F.coalesce("there", F.lit(False)).alias("t"), F.coalesce("ops", F.lit("")).alias("o"))
    found = {(r.t, r.o) for r in cells.distinct().collect()}
    sets = ["D", "I", "U", "DI", "DU", "IU", "DIU"]
    assert found == {(t, o) for t in (True, False) for o in sets} | {(True, "")}


BROKEN = {
    "merge_net": ("net", lambda t, c, k, o: changes.latest(c, k, o).filter("op <> 'D'").select(*t.columns)),
    "merge_phased": ("phased", lambda t, c, k, o: t.limit(0)),
    "merge_delete": ("merge_delete", lambda t, c, k: t.limit(0)),
    "merge_update": ("merge_update", lambda t, c, k: t.join(c.select(*k), k, "left_semi")),
}


@pytest.mark.parametrize("name", list(BROKEN))
def test_a_broken_merge_does_not_pass(spark, con, monkeypatch, name):
    monkeypatch.setattr(merge, *BROKEN[name])
    assert compare.difference(spark, con, name, DIR) is not None


def test_net_changes_shuffle_once(spark):
    assert plan_of(changes.latest(X.changelog(spark, DIR), X.KEYS, X.ORDER)).count("Exchange") == 1


def test_a_small_batch_leaves_the_target_where_it_is(spark, folder):
    """The target is not shuffled when the staged changes are below Spark's broadcast limit."""
    X.target(spark, DIR).write.parquet(f"{folder}/t")
    X.batch(spark, DIR).write.parquet(f"{folder}/b")
    plan = plan_of(merge.net(spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/b"), X.SLOT_KEYS, X.ORDER))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_merges_agree_without_any_broadcast(spark, con):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("merge_net", "merge_phased", "merge_update", "merge_delete", "merge_insert", "merge_counts", "replay_guard"):
            assert compare.difference(spark, con, name, DIR) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_micro_batches_do_not_grow_in_number_with_the_table(spark, con, monkeypatch):
    """A table in many splits brings larger micro-batches, not more of them: each costs a round over all state partitions."""
    runs, start = [], jobs.start_landing
    monkeypatch.setattr(jobs, "start_landing", lambda *a, **k: runs.append(start(*a, **k)) or runs[-1])
    monkeypatch.setattr(X, "dealt", lambda rows: rows.repartition(12))
    assert compare.difference(spark, con, "stream_dedupe", DIR) is None
    assert len(runs) == 4 and runs[-1].lastProgress["batchId"] < 4 * 4


def test_a_batch_that_comes_again_is_not_classified_again(spark, con, monkeypatch):
    deliver, stored = intake.deliver, []

    def seen(cfg, classified, letters, publish, batch=None, **more):
        stored.append((batch, classified.storageLevel.useMemory))
        return deliver(cfg, classified, letters, publish, batch, **more)

    monkeypatch.setattr(intake, "deliver", seen)
    assert compare.difference(spark, con, "delivery_log", DIR) is None
    assert stored == [("intake-0", False), ("intake-1", True), ("intake-2", False), ("intake-1", True)]
