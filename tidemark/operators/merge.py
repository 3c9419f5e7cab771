"""Keyed merge of a change set into a target.

All joins are equi-joins on the key columns with plain equality, as in MERGE: a null key
matches nothing. The sides built from changes hold one narrow row per key, so Spark
broadcasts them where its size check allows and then reads the target without moving it;
beyond that limit the same plan runs as a shuffled join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import DELETE, INSERT, UPDATE, latest, newest, position


def match_condition(keys: Sequence[str], target: str = "target", source: str = "source") -> Column:
    """``target.k = source.k`` for every key column, joined by AND."""
    return reduce(and_, [F.col(f"{target}.`{k}`") == F.col(f"{source}.`{k}`") for k in keys])


def merge_insert(target: DataFrame, inserts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE .. WHEN NOT MATCHED THEN INSERT. ``inserts`` holds one row per key."""
    fresh = inserts.join(target.select(*quoted(keys)), list(keys), "left_anti")
    return target.unionByName(fresh.select(*quoted(target.columns)))


def merge_update(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE .. WHEN MATCHED THEN UPDATE, whole rows. ``updates`` holds one row per key.

    One outer join decides per target row; a key without a match in the target is
    dropped, and a null in the update replaces the old value.
    """
    payload = [c for c in target.columns if c not in keys]
    new = updates.select(*quoted(keys), F.struct(*quoted(payload)).alias("_new"))
    joined = target.join(new, list(keys), "left_outer")
    picked = [
        F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in payload else F.col(f"`{c}`")
        for c in target.columns
    ]
    return joined.select(*picked)


def merge_delete(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE .. WHEN MATCHED THEN DELETE."""
    return target.join(_distinct_keys(deletes, keys), list(keys), "left_anti")


def net(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Target after all changes in chronological order (the default merge).

    Every key with a change leaves the target and comes back with its last change unless
    that is a delete. The first step needs the keys only, so it scans the key columns and
    pre-aggregates them; the payload is read and shuffled once.
    """
    kept = target.join(_distinct_keys(changes, keys), list(keys), "left_anti")
    needed = changes.select(*quoted(dict.fromkeys([*target.columns, "op", *order])))
    last = latest(needed, keys, order).filter(F.col("op") != DELETE)
    return kept.unionByName(last.select(*quoted(target.columns)))


def phased(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Target after three merges, all inserts, then all updates, then all deletes.

    Every merge takes the last change of its kind per key. The phases ignore how the
    kinds interleave in time, so a key that has any delete ends up absent. The three
    merges collapse into one outer join: changes fold into one row per key holding the last
    insert, the last update and whether there is a delete, and each side is read once.
    """
    payload = list(target.columns)
    folded = per_kind(changes, keys, order, payload)
    # a null key matches nothing, on either side
    joined = target.withColumn("_held", F.lit(True)).join(folded, list(keys), "full_outer")
    held, replaced = F.col("_held").isNotNull(), F.col("_update").isNotNull()
    alive = held | F.col("_insert").isNotNull()

    def value(c: str) -> Column:
        fresh = F.when(replaced, F.col("_update")[c]).when(~held, F.col("_insert")[c])
        return F.col(f"`{c}`") if c in keys else fresh.otherwise(F.col(f"`{c}`")).alias(c)

    return joined.filter(alive & ~F.coalesce("_deleted", F.lit(False))).select(*[value(c) for c in payload])


def per_kind(changes: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per key: last insert row, last update row, and whether a delete occurs."""
    last_of = lambda kind: newest(changes.schema, payload, order, F.col("op") == kind)
    return changes.groupBy(*quoted(keys)).agg(
        last_of(INSERT).alias("_insert"),
        last_of(UPDATE).alias("_update"),
        F.bool_or(F.col("op") == DELETE).alias("_deleted"),
    )


def fold(state: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """State after a batch, where state keeps the last change of every key.

    Deletes stay as rows with ``op = 'D'``, so a change older than what the state holds
    is recognised and ignored: which of two changes wins is decided as in ``changes.latest``, down to
    the last column. That makes folding independent of batch order and safe to
    repeat. ``batch`` has the columns of ``state`` and one row per key (``latest``).

    If the batch is small enough Spark broadcasts it and leaves the state where it is: of the state only the keys that the batch
    has too are moved, to find those it does not have.
    """
    columns = list(state.columns)
    rest = [c for c in columns if c not in keys]
    fields = list(dict.fromkeys([*[c for c in order if c not in keys], *rest]))
    new = batch.select(*quoted(keys), *[F.col(f"`{c}`").alias(f"_new_{c}") for c in rest], F.lit(True).alias("_new"))
    newer = position(state.schema, fields, lambda c: f"_new_{c}") > position(state.schema, fields)
    joined = state.join(new, list(keys), "left_outer")
    wins = F.col("_new").isNotNull() & newer
    kept = joined.select(
        *[F.col(f"`{c}`") if c in keys else F.when(wins, F.col(f"`_new_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in columns]
    )
    held = state.select(*quoted(keys)).join(_distinct_keys(batch, keys), list(keys), "left_semi")
    born = batch.join(held, list(keys), "left_anti")
    return kept.unionByName(born.select(*quoted(columns)))


def live(state: DataFrame, order: Sequence[str], keep_order: bool = False) -> DataFrame:
    """Rows of a folded state that exist, without the bookkeeping columns."""
    rows = state.filter(F.col("op") != DELETE).drop("op")
    return rows if keep_order else rows.drop(*order)


def merge_into_table(changes: DataFrame, table: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Net merge as one MERGE INTO, for catalogs with row-level operations.

    The source columns besides ``op`` must be those of the table.
    """
    source = latest(changes, keys, order).alias("source")
    name = table.split(".")[-1]
    deleted = F.col("source.op") == DELETE
    columns = {c: F.col(f"source.{c}") for c in changes.columns if c != "op"}
    (
        source.mergeInto(table, match_condition(keys, name))
        .whenMatched(deleted).delete()
        .whenMatched().update(columns)
        .whenNotMatched(~deleted).insert(columns)
        .merge()
    )


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns of these names, whatever characters are in them."""
    return [F.col(f"`{name}`") for name in names]


def _distinct_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.select(*quoted(keys)).distinct()
