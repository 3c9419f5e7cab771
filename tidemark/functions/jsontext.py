"""JSON text and variant helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Appended to every text before parsing. The parser stops after the first complete
# value, so only texts that are one whole JSON value each leave this mark in the place behind them.
_END = "~end~"


def decoded(raw: str) -> Column:
    """Text of a bytes column; null where the bytes are not UTF-8."""
    text = F.col(raw).cast("string")
    return F.when(F.is_valid_utf8(text), text)


def is_blank(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.length(F.btrim(c, F.lit(" \t\r\n"))) == 0


def bracketed(*texts: str) -> Column:
    """One text, or several side by side, as elements of an array that is parsed to a variant."""
    parts = [part for t in texts for part in (F.col(t), F.lit(","))]
    return F.try_parse_json(F.concat(F.lit("["), *parts, F.lit(f'"{_END}"]')))


def is_whole(parsed: str | Column, texts: int = 1) -> Column:
    """True where every text behind :func:`bracketed` is exactly one JSON value."""
    p = F.col(parsed) if isinstance(parsed, str) else parsed
    end, more = F.try_variant_get(p, f"$[{texts}]", "string"), F.try_variant_get(p, f"$[{texts + 1}]", "string")
    return F.coalesce((end == _END) & more.isNull(), F.lit(False))


def in_line(parsed: str | Column, *path: str, as_type: str = "variant", root: str = "$[0]") -> Column:
    """A member of a parsed text by its path, null if absent or of another type.

    Reading typed members straight off the parsed line spares a copy of what surrounds them.
    """
    p = F.col(parsed) if isinstance(parsed, str) else parsed
    return F.try_variant_get(p, root + _steps(path), as_type)


def line_has(parsed: str, name: str) -> Column:
    """Whether the line is an object with this member, whatever its value."""
    is_object = in_line(parsed, name, as_type="struct<>").isNotNull()
    return F.when(is_object, F.lit(True)).otherwise(in_line(parsed, name).isNotNull())


def member(doc: str | Column, *path: str, as_type: str = "variant") -> Column:
    """A member of a variant object by its path, null if it is absent or of another type."""
    d = F.col(doc) if isinstance(doc, str) else doc
    return F.try_variant_get(d, "$" + _steps(path), as_type)


def member_count(doc: str | Column) -> Column:
    """Number of members of a variant object, null for anything else."""
    return F.size(member(doc, as_type="map<string,variant>"))


def absent(value: Column) -> Column:
    """True for SQL null (no such member) and for JSON null."""
    return value.isNull() | F.is_variant_null(value)


def json_bytes(value: Column) -> Column:
    """A struct as UTF-8 JSON bytes, the form keys and values have on a topic."""
    return F.encode(F.to_json(value), "UTF-8")


def _steps(path: tuple[str, ...]) -> str:
    return "".join(f'["{p}"]' for p in path)
