"""Merge jobs: a day, or a stream, of raw changes into the target.

The target is plain Parquet. A daily job writes the whole state as the snapshot of its day, from the snapshot before;
run again it does the same again. A stream appends the net changes of each micro-batch and costs as much
as these; who reads the target folds them over the newest snapshot, and the daily job takes them in. Catalogs with
row-level operations take ``merge.merge_into_table`` instead.

State and changes have the columns of the raw rows. A deleted key stays as a row with ``op = 'D'``, so that an older
change cannot bring it back, until ``keep_deletes_us`` of event time have passed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import micros
from tidemark.operators import deadletter, merge
from tidemark.operators.changes import DELETE, latest
from tidemark.plans.deadletters import Letters
from tidemark.sources import batches, rawzone

NET, PHASED = "net", "phased"


@dataclass(frozen=True)
class Target:
    """Snapshots by day and the changes since, in one folder."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]

    def snapshot(self, before: str | None = None) -> DataFrame:
        """The newest snapshot, or the newest of a day before the one given; none for a new target."""
        name = batches.latest_name(self.spark, f"{self.path}/snapshots", before)
        if name is None:
            return self.spark.createDataFrame([], self.schema)
        return batches.exact(self.spark, f"{self.path}/snapshots", name, self.schema)

    def changes(self) -> DataFrame:
        return batches.read(self.spark, f"{self.path}/changes", self.schema)

    def state(self) -> DataFrame:
        """The last change of every key, deletes included.

        The changes since the snapshot are folded over it: where they are below Spark's broadcast limit, the snapshot is
        read where it is.
        """
        since = latest(self.changes(), self.keys, self.order)
        if batches.latest_name(self.spark, f"{self.path}/snapshots") is None:
            return since
        return merge.fold(self.snapshot(), since, self.keys, self.order)

    def rows(self) -> DataFrame:
        """The rows that exist."""
        return merge.live(self.state(), self.order)

    def add(self, changes: DataFrame, batch: str) -> None:
        """Appends the net changes of a micro-batch; run again it replaces them."""
        net = latest(changes.select(*self.schema.fieldNames()), self.keys, self.order)
        batches.append(net, f"{self.path}/changes", batch)

    def store(self, state: DataFrame, day: str) -> None:
        batches.append(state.select(*self.schema.fieldNames()), f"{self.path}/snapshots", day)


def merge_day(
    target: Target,
    raw_path: str,
    run_date: str,
    fmt: str = "parquet",
    mode: str = NET,
    keep_deletes_us: int | None = None,
    dead: Letters | None = None,
) -> None:
    """Merges the raw folder of the day before the run and stores the snapshot of the run's day."""
    merge_changes(target, day_rows(target, raw_path, run_date, fmt, dead), run_date, mode, keep_deletes_us)


def day_rows(target, raw_path: str, run_date: str, fmt: str, dead: Letters | None = None) -> DataFrame:
    """The raw changes of the day before the run, in the target's columns.

    A text row that does not fit them goes to ``dead``, under the run's day, so that a repeated run puts it once; without
    dead letters it stops the job.
    """
    if dead is None:
        return rawzone.read_day(target.spark, raw_path, target.schema, run_date, fmt).drop(rawzone.DAY)
    rows, faulty = rawzone.split(rawzone.read_checked(target.spark, raw_path, target.schema, run_date, fmt))
    letters = deadletter.puts(faulty, "raw", deadletter.message_key("raw"), F.lit(rawzone.MALFORMED))
    dead.put(letters, f"raw-{run_date}")
    return rows.drop(rawzone.DAY)


def merge_changes(
    target: Target, changes: DataFrame, day: str, mode: str = NET, keep_deletes_us: int | None = None
) -> None:
    """Merges changes into the snapshot before ``day`` and stores the result as that of ``day``.

    The changes are stored first, reduced to the last one per key, or per key and kind in
    phased mode. Spark then knows their exact size when it plans the join: small ones are broadcast, and the
    state is read and written where it is.
    """
    if mode not in (NET, PHASED):
        raise ValueError(f"unknown merge mode {mode!r}")
    keys, order = target.keys, target.order
    reduced = latest(changes.select(*target.schema.fieldNames()), keys if mode == NET else [*keys, "op"], order)
    staging = f"{target.path}/staged"
    batches.append(reduced, staging, day)
    staged = batches.exact(target.spark, staging, day, target.schema)
    state = target.snapshot(before=day)
    merged = merge.fold(state, staged, keys, order) if mode == NET else _phased(state, staged, keys, order)
    if keep_deletes_us is not None:
        merged = without_old_deletes(merged, staged, order[0], keep_deletes_us)
    target.store(merged, day)


def without_old_deletes(state: DataFrame, staged: DataFrame, time: str, keep_us: int) -> DataFrame:
    """State without deletes that are more than ``keep_us`` older than the newest change; ``time`` in micros or a timestamp."""
    is_time = isinstance(state.schema[time].dataType, T.TimestampType | T.TimestampNTZType)
    at = micros(time) if is_time else F.col(time)
    newest = staged.agg(F.max(at).alias("t")).first()["t"]
    if newest is None:
        return state
    return state.filter(~((F.col("op") == DELETE) & F.coalesce(at < F.lit(newest - keep_us), F.lit(False))))


def expire_snapshots(target: Target, keep: int = 7) -> list[str]:
    """Scheduled: all but the newest ``keep`` snapshots go, and the staged changes of their days; returns which."""
    if keep < 1:
        raise ValueError("the newest snapshot is the target")
    old = batches.names(target.spark, f"{target.path}/snapshots")[:-keep]
    for folder in ("snapshots", "staged"):
        there = set(batches.names(target.spark, f"{target.path}/{folder}"))
        batches.remove(target.spark, f"{target.path}/{folder}", [d for d in old if d in there])
    return old


def compact(target: Target, day: str) -> None:
    """Daily, for a stream: a new snapshot takes in the changes there are, which then go."""
    folder = f"{target.path}/changes"
    taken = batches.names(target.spark, folder)
    last = batches.latest_name(target.spark, f"{target.path}/snapshots")
    if last is not None and last >= day:
        raise ValueError(f"there is a snapshot of {last} already")
    if not taken:
        return
    changes = target.changes().select(*target.schema.fieldNames())
    state = target.snapshot()
    target.store(merge.fold(state, latest(changes, target.keys, target.order), target.keys, target.order), day)
    batches.rewrite(target.spark.createDataFrame([], target.schema), folder, taken)


def _phased(state: DataFrame, staged: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Three merges on the rows that exist; deletes stay remembered for keys that do not."""
    rows = merge.phased(state.filter(F.col("op") != DELETE), staged, keys, order)
    deletes = latest(state.unionByName(staged).filter(F.col("op") == DELETE), keys, order)
    return rows.unionByName(deletes.join(rows.select(*keys), list(keys), "left_anti").select(*rows.columns))
