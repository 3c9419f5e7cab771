"""Change sets: net change per key, duplicates, splits by operation, conflict report.

A change is a row with the key columns, the payload, ``op`` in {I, U, D} and the columns
that order changes in time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INSERT, UPDATE, DELETE = "I", "U", "D"
OPS = (INSERT, UPDATE, DELETE)


def normal_op(op: str | Column) -> Column:
    """Operation code without regard to case and blanks around it; null when unknown."""
    code = F.upper(F.trim(F.col(op) if isinstance(op, str) else op))
    return F.when(code.isin(*OPS), code)


def latest(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change of every key, whole rows.

    The aggregate combines before its shuffle: a key with a third of all changes leaves
    one row per map task. It sorts by key only and holds one row per key, where ranking
    would sort every key's rows. All columns of ``changes`` are carried along, so select
    the ones needed first.
    """
    time = [c for c in order if c not in keys]
    payload = [c for c in changes.columns if c not in keys]
    last = changes.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(newest(changes.schema, payload, time).alias("_row"))
    return last.select(*[F.col(f"`{c}`") if c in keys else F.col("_row")[c].alias(c) for c in changes.columns])


def newest(schema: T.StructType, columns: Sequence[str], order: Sequence[str], where: Column | None = None) -> Column:
    """Aggregate: the newest row as a struct of ``columns`` and ``order``, of rows that hold ``where``.

    Newest is the greatest in the order columns, then in the other columns, so that of two rows of the
    same instant it is always the same one that wins (:func:`position`). Where all columns can be
    compared the row is its own position and travels once.
    """
    fields = list(dict.fromkeys([*order, *columns]))
    row, place = F.struct(*[F.col(f"`{c}`") for c in fields]), position(schema, fields)
    if where is not None:
        row, place = F.when(where, row), F.when(where, place)
    if all(_is_comparable(schema[c].dataType) for c in fields):
        return F.max(row)
    return F.max_by(row, place)


def position(schema: T.StructType, fields: Sequence[str], name: Callable[[str], str] = lambda c: c) -> Column:
    """What puts two changes of a key in order: ``fields`` one after the other.

    Maps and variants have no order of their own; their JSON text stands for them. ``name`` says under
    which column name a field is found.
    """
    return F.struct(*[_comparable(F.col(f"`{name(c)}`"), schema[c].dataType).alias(c) for c in fields])


def _comparable(value: Column, t: T.DataType) -> Column:
    if _is_comparable(t):
        return value
    if isinstance(t, T.MapType):
        # entries by key: maps that are equal have equal text
        return F.to_json(F.array_sort(F.map_entries(value))) if _is_comparable(t.valueType) else F.to_json(value)
    return F.to_json(value) if isinstance(t, T.VariantType) else F.to_json(F.struct(value.alias("v")))


def _is_comparable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_is_comparable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _is_comparable(t.elementType)
    return not isinstance(t, T.MapType | T.VariantType)


def split_by_op(changes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inserts, updates and deletes of a change set."""
    inserts, updates, deletes = (changes.filter(F.col("op") == code) for code in OPS)
    return inserts, updates, deletes


def count_by_op(changes: DataFrame) -> DataFrame:
    return changes.groupBy("op").agg(F.count("*").alias("n"))


def dedupe(changes: DataFrame, identity: Sequence[str]) -> DataFrame:
    """One row per identity. The copies are equal, so any of them may stay."""
    return changes.dropDuplicates(list(identity))


def repeats(rows: DataFrame, digest: str, place: str) -> DataFrame:
    """Digests that occur more than once, with the least place: ``digest`` and ``_first``.

    Only digests and places are shuffled, whatever else a row holds; the result is as large as there are repeats.
    """
    found = rows.groupBy(digest).agg(F.min(place).alias("_first"), F.count("*").alias("_n"))
    return found.filter("_n > 1").drop("_n")


def without_repeats(rows: DataFrame, repeated: DataFrame, digest: str, place: str) -> DataFrame:
    """Rows without those that :func:`repeats` found a second time."""
    first = rows.join(repeated, digest, "left_outer")
    return first.filter(F.col("_first").isNull() | (F.col("_first") == F.col(place))).drop("_first")


def dedupe_stream(changes: DataFrame, identity: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Streaming form: copies that arrive within ``delay`` of event time are removed."""
    return changes.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(identity))


def ambiguous(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with several changes of one kind, which a plain MERGE cannot resolve."""
    return changes.groupBy(*keys, "op").agg(F.count("*").alias("n")).filter("n > 1")
