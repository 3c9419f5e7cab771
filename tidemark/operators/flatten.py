"""Schema-driven flattening of row images.

Scalars below structs become ``parent_child`` columns; a field below an array becomes one
array column per leaf, in element order, duplicates and nulls kept. The walk reads the
schema only and yields one select list.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain
from itertools import count as naturals

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Flat form of ``df``. ``rename`` maps a dotted path to a column name of its own.

    Without it an array leaf is called ``<top field>_<leaf>s``, or by its full path where
    that name is taken.
    """
    leaves = [leaf for f in df.schema.fields for leaf in _leaves(F.col(f"`{f.name}`"), f.dataType, (f.name,), 0)]
    names = _names([path for path, _, _ in leaves], [depth for _, _, depth in leaves], rename or {})
    return df.select(*[value.alias(name) for (_, value, _), name in zip(leaves, names, strict=True)])


def _names(paths: list[tuple[str, ...]], depths: list[int], rename: dict[str, str]) -> list[str]:
    """A name of its own for every leaf, compared without regard to case as Spark does.

    Given names come first, then fields at the top, which keep theirs; a leaf whose short
    name and whose path are both taken gets its path with a number.
    """
    short = [_short_name(path, depth) for path, depth in zip(paths, depths, strict=True)]
    wanted = [rename.get(".".join(path)) for path in paths]
    given = [w.lower() for w in wanted if w is not None]
    if len(set(given)) < len(given):
        raise ValueError(f"two fields are to be called the same: {sorted(given)}")
    top = [path[0].lower() for path, w in zip(paths, wanted, strict=True) if len(path) == 1 and w is None]
    if clash := set(given) & set(top):
        raise ValueError(f"a field is to be called like one at the top: {sorted(clash)}")
    taken = {*given, *top}
    count = Counter(name.lower() for name in short)
    names = []
    for path, name, own in zip(paths, short, wanted, strict=True):
        if own is None and len(path) > 1:
            path_name = "_".join(path)
            choices = chain([name] if count[name.lower()] == 1 else [], [path_name], (f"{path_name}_{k}" for k in naturals(2)))
            own = next(c for c in choices if c.lower() not in taken)
            taken.add(own.lower())
        names.append(own or name)
    return names


def _leaves(value: Column, kind: T.DataType, path: tuple[str, ...], depth: int) -> Iterator[tuple[tuple, Column, int]]:
    """``(path, expression, array depth)`` of every leaf below ``value``."""
    while isinstance(kind, T.ArrayType):
        kind, depth = kind.elementType, depth + 1
    if not isinstance(kind, T.StructType):
        yield path, value, depth
        return
    for f in kind.fields:
        yield from _leaves(_field(value, f.name, depth), f.dataType, (*path, f.name), depth)


def _field(value: Column, name: str, depth: int) -> Column:
    """A field of a struct, or of every struct in an array.

    Field access reaches through one array by itself, and prunes the scan to that field;
    each further array level takes a ``transform``.
    """
    if depth <= 1:
        return value.getField(name)
    return F.transform(value, lambda element: _field(element, name, depth - 1))


def _short_name(path: tuple[str, ...], depth: int) -> str:
    return f"{path[0]}_{path[-1]}s" if depth and len(path) > 1 else "_".join(path)
