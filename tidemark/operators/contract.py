"""Row contract: registered schema -> violations, drift, and the schema history table.

``from_json`` alone does not validate: it fills missing fields with null and turns numbers
into text. The tests here look at presence and type of every leaf in the variant itself,
also inside arrays. They are built on the driver from the schema and run as native
expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.jsontext import absent

_SCALARS: dict[type, tuple[str, ...]] = {
    T.StringType: ("STRING",),
    T.DoubleType: ("DOUBLE", "FLOAT", "BIGINT", "DECIMAL"),
    T.FloatType: ("DOUBLE", "FLOAT", "BIGINT", "DECIMAL"),
    T.LongType: ("BIGINT",),
    T.IntegerType: ("BIGINT",),
    T.BooleanType: ("BOOLEAN",),
}

_AVRO_SCALARS = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
}


# ---------------------------------------------------------------- validation


_SEPARATOR = "\n"


def with_violations(rows: DataFrame, image: str, schema: T.StructType, name: str = "violations") -> DataFrame:
    """Adds ``array<string>`` of ``path:missing``, ``path:null`` and ``path:type``, empty if valid.

    Every schema field is required and not null. Further fields are allowed. Below an
    array a path is reported once, whatever the number of elements it concerns. Without
    an image the result is null.

    The kind of a value says everything at once: null for an absent field, VOID for JSON
    null, else its type. Kinds get columns of their own, so that each is worked out once.
    """
    kinds: list[Column] = []
    joined = F.concat_ws(_SEPARATOR, *_object_faults(F.col(image), schema, "", kinds))
    looked_up = rows.select("*", *[k.alias(f"_kind_{i}") for i, k in enumerate(kinds)])
    looked_up = looked_up.withColumn("_faults", F.when(~absent(F.col(image)), joined))
    return looked_up.select(
        *rows.columns,
        F.when(F.col("_faults") == "", F.array().cast("array<string>"))
        .otherwise(F.split("_faults", _SEPARATOR))
        .alias(name),
    )


def _object_faults(parent: Column, schema: T.StructType, prefix: str, kinds: list[Column] | None) -> list[Column]:
    """One test per field of an object and below; a test is null or the violation's text.

    With ``kinds`` the kind of a value is registered there and read back by column name;
    below an array there are no such columns and it is used in place.
    """
    found = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        value = F.try_variant_get(parent, f'$["{f.name}"]', "variant")
        seen = F.schema_of_variant(value)
        if kinds is not None:
            kinds.append(seen)
            seen = F.col(f"_kind_{len(kinds) - 1}")
        found.append(_verdict(seen, value, f.dataType, path))
        if isinstance(f.dataType, T.StructType):
            inside = _object_faults(value, f.dataType, f"{path}.", kinds)
            found += [F.when(seen.startswith("OBJECT"), test) for test in inside]
        elif isinstance(f.dataType, T.ArrayType):
            found.append(_array_faults(value, f.dataType.elementType, path))
    return found


def _array_faults(value: Column, element: T.DataType, path: str) -> Column:
    """Violations of all elements as one text; null if there are none or it is no array."""

    def faults_of(v: Column) -> Column:
        seen = F.schema_of_variant(v)
        tests = [_verdict(seen, v, element, f"{path}[]")]
        if isinstance(element, T.StructType):
            inside = _object_faults(v, element, f"{path}.", None)
            tests += [F.when(seen.startswith("OBJECT"), test) for test in inside]
        elif isinstance(element, T.ArrayType):
            tests.append(_array_faults(v, element.elementType, f"{path}[]"))
        faults = F.concat_ws(_SEPARATOR, *tests)
        exact = _exact_kind(element)
        return faults if exact is None else F.when(seen == exact, "").otherwise(faults)

    per_element = F.array_distinct(F.transform(F.try_variant_get(value, "$", "array<variant>"), faults_of))
    # an array without fault leaves at most one empty text; only others are taken apart
    each_fault = F.array_distinct(F.split(F.array_join(F.array_remove(per_element, ""), _SEPARATOR), _SEPARATOR))
    return F.when(F.size(F.array_remove(per_element, "")) > 0, F.array_join(each_fault, _SEPARATOR))


def _exact_kind(t: T.DataType) -> str | None:
    """The only kind text a valid value can have if it has no further fields, if there is one."""
    if isinstance(t, T.StructType):
        inner = {f.name: _exact_kind(f.dataType) for f in t.fields}
        if None in inner.values() or not all(n.isidentifier() for n in inner):
            return None
        return "OBJECT<" + ", ".join(f"{n}: {inner[n]}" for n in sorted(inner)) + ">"
    if isinstance(t, T.IntegerType):
        return None  # the kind does not tell the range
    names = _SCALARS.get(type(t), ())
    return names[0] if len(names) == 1 else None


def _verdict(seen: Column, value: Column, wanted: T.DataType, path: str) -> Column:
    found = F.when(seen.isNull(), f"{path}:missing").when(seen == "VOID", f"{path}:null").when(~_fits(seen, wanted), f"{path}:type")
    if isinstance(wanted, T.IntegerType | T.LongType):
        # whole numbers of any length are read as far as they fit
        found = found.when(F.try_variant_get(value, "$", wanted.simpleString()).isNull(), f"{path}:type")
    return found


def _fits(seen: Column, wanted: T.DataType) -> Column:
    if isinstance(wanted, T.StructType):
        return seen.startswith("OBJECT")
    if isinstance(wanted, T.ArrayType):
        return seen.startswith("ARRAY")
    names = _SCALARS[type(wanted)]
    fits = seen.isin(*names)
    # a decimal's type text carries its precision
    return fits | seen.startswith("DECIMAL") if "DECIMAL" in names else fits


def _kind(type_text: Column) -> Column:
    """``BIGINT``, ``DECIMAL``, ``ARRAY`` .. without precision or element types."""
    return F.substring_index(F.substring_index(type_text, "<", 1), "(", 1)


# ---------------------------------------------------------------- schema text


def struct_of_avro(schema_json: str) -> T.StructType:
    """Spark schema of a registered Avro record schema (scalars, records, arrays).

    A dotted field name stands for nesting: ``a.b`` becomes field ``b`` of struct ``a``.
    """
    return _record(json.loads(schema_json))


def avro_of_struct(name: str, schema: T.StructType) -> str:
    """Avro record text of a Spark schema, the form kept in the schema history."""
    return json.dumps(_avro_record(name, schema), separators=(",", ":"))


def _record(node: dict) -> T.StructType:
    tree: dict = {}
    for f in node["fields"]:
        *parents, leaf = f["name"].split(".")
        place = tree
        for p in parents:
            place = place.setdefault(p, {})
        place[leaf] = _type_of(f["type"])
    return _struct_of_tree(tree)


def _struct_of_tree(tree: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(n, _struct_of_tree(t) if isinstance(t, dict) else t) for n, t in tree.items()]
    )


def _type_of(node) -> T.DataType:
    if isinstance(node, dict):
        if node["type"] == "array":
            return T.ArrayType(_type_of(node["items"]))
        return _record(node) if node["type"] == "record" else _type_of(node["type"])
    if node not in _AVRO_SCALARS:
        raise ValueError(f"no row type for Avro type {node!r}")
    return _AVRO_SCALARS[node]


def _avro_record(name: str, schema: T.StructType) -> dict:
    return {
        "type": "record",
        "name": name,
        "fields": [{"name": f.name, "type": _avro_type(f.name, f.dataType)} for f in schema.fields],
    }


def _avro_type(name: str, t: T.DataType):
    if isinstance(t, T.StructType):
        return _avro_record(name, t)
    if isinstance(t, T.ArrayType):
        return {"type": "array", "items": _avro_type(name, t.elementType)}
    return next(n for n, scalar in _AVRO_SCALARS.items() if scalar == t)


# ---------------------------------------------------------------- schema history

HISTORY_SCHEMA = "subject string, version int, schema_json string, retired boolean"


def latest(history: DataFrame) -> DataFrame:
    """Latest version of every subject that is not retired."""
    return (
        history.filter(~F.col("retired"))
        .groupBy("subject")
        .agg(F.max_by("schema_json", "version").alias("schema_json"), F.max("version").alias("version"))
        .select("subject", "version", "schema_json")
    )


def latest_schema(history: DataFrame, subject: str) -> T.StructType:
    """The row schema in force for one subject, looked up once on the driver."""
    row = latest(history.filter(F.col("subject") == subject)).first()
    if row is None:
        raise LookupError(f"no schema registered for {subject}")
    return struct_of_avro(row["schema_json"])


def register(history: DataFrame, new: DataFrame) -> DataFrame:
    """History with one more version for every subject in ``new`` ``(subject, schema_json)``.

    A schema equal to the subject's latest one adds no version. ``new`` names a subject
    once; a second row for it fails the job instead of winning by chance.
    """
    return history.unionByName(next_versions(history, new, keep_equal=False))


def replace(history: DataFrame, new: DataFrame) -> DataFrame:
    """History in which ``new`` supersedes all versions of its subjects.

    The old versions stay as retired rows, so the history can still be audited.
    """
    replaced = new.select("subject").distinct().withColumn("_replaced", F.lit(True))
    marked = history.join(replaced, "subject", "left_outer").select(
        "subject", "version", "schema_json", (F.col("retired") | F.col("_replaced").isNotNull()).alias("retired")
    )
    return marked.unionByName(next_versions(history, new, keep_equal=True))


def next_versions(history: DataFrame, new: DataFrame, keep_equal: bool) -> DataFrame:
    """The rows that ``new`` adds to the history."""
    current = history.groupBy("subject").agg(
        F.max("version").alias("_last"),
        F.max_by("schema_json", F.when(~F.col("retired"), F.col("version"))).alias("_in_force"),
    )
    once = new.groupBy("subject").agg(F.max("schema_json").alias("schema_json"), F.count("*").alias("_n"))
    only = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("subject named twice: "), "subject"))).otherwise(
        F.col("schema_json")
    )
    joined = once.join(current, "subject", "left_outer")
    if not keep_equal:
        joined = joined.filter(~F.col("schema_json").eqNullSafe(F.col("_in_force")))
    return joined.select(
        "subject",
        (F.coalesce("_last", F.lit(0)) + 1).cast("int").alias("version"),
        only.alias("schema_json"),
        F.lit(False).alias("retired"),
    )


# ---------------------------------------------------------------- drift


def drift(
    spark: SparkSession, images: DataFrame, schema: T.StructType, image: str = "image", nested: bool = False
) -> DataFrame:
    """Fields seen in the row images against the registered ones.

    One row per field and type with a count and a status: ``ok``, ``type_changed``,
    ``new_field``, or ``missing_field`` for a registered field no image has. With ``nested`` also the
    fields of registered structs, and of the structs in registered arrays, by their dotted path; an image gives the
    members of all levels at once, so the images are read once.
    """
    registered = dict(_registered(schema, "", nested))
    levels, members = images.select(F.col(image).alias("_values_0")), []
    levels = _with_members(levels.withColumn("_values_0", F.array("_values_0")), schema, "", nested, members)
    seen = levels.select(F.explode(F.concat(*members)).alias("_m"))
    seen = seen.select(F.col("_m.field").alias("field"), F.col("_m.type").alias("_type"), F.col("_m.n").alias("_n"))
    checks = [
        F.when(F.col("field") == path, F.when(_fits(F.col("_type"), t), "ok").otherwise("type_changed"))
        for path, t in registered.items()
    ]
    # nested types can spell out differently in every row, the outer kind is what is counted
    kind = _kind(F.col("_type"))
    counted = (
        seen.select("field", kind.alias("observed_type"), F.coalesce(*checks, F.lit("new_field")).alias("status"), "_n")
        .groupBy("field", "observed_type", "status")
        .agg(F.sum("_n").alias("n"))
        .select("field", "observed_type", "n", "status")
    )
    expected = spark.createDataFrame(
        [(path, "none", 0, "missing_field") for path in registered],
        "field string, observed_type string, n bigint, status string",
    )
    # per field at most one entry for each kind of value there is
    entry = F.struct("observed_type", "n", "status")
    per_field = counted.unionByName(expected).groupBy("field").agg(F.collect_list(entry).alias("_all"))
    found = F.filter("_all", lambda e: e["n"] > 0)
    return per_field.select("field", F.inline(F.when(F.size(found) > 0, found).otherwise(F.col("_all"))))


def _registered(schema: T.StructType, prefix: str, nested: bool) -> Iterator[tuple[str, T.DataType]]:
    for f in schema.fields:
        yield prefix + f.name, f.dataType
        inner = _element(f.dataType)
        if nested and isinstance(inner, T.StructType):
            yield from _registered(inner, f"{prefix}{f.name}.", nested)


def _element(t: T.DataType) -> T.DataType:
    while isinstance(t, T.ArrayType):
        t = t.elementType
    return t


# objects of one array that differ in more ways than this are counted one by one
_SHAPES = 16
_MEMBERS = "array<struct<field:string,type:string,n:bigint>>"


def _with_members(rows: DataFrame, schema: T.StructType, prefix: str, nested: bool, members: list[Column]) -> DataFrame:
    """Adds columns for the values of one level and below, and to ``members`` the path, kind and number of what they hold.

    The values of a level are in the newest ``_values_`` column. Those of one type text, which names all members and
    their types, hold the same members: these are looked up in one of them and count for all. What lies below is taken from every value.
    """
    k = len(members)
    values, shapes = F.col(f"_values_{k}"), F.col(f"_shapes_{k}")
    rows = rows.withColumn(f"_shapes_{k}", F.when(F.size(values) > 1, F.transform(values, F.schema_of_variant)))
    rows = rows.withColumn(f"_kinds_{k}", F.array_distinct(shapes))
    kinds = F.col(f"_kinds_{k}")
    one = lambda s: F.struct(F.get(values, F.array_position(shapes, s).cast("int") - 1).alias("v"), F.size(F.filter(shapes, lambda x: x == s)).cast("bigint").alias("n"))
    alone = F.transform(values, lambda v: F.struct(v.alias("v"), F.lit(1).cast("bigint").alias("n")))
    rows = rows.withColumn(f"_found_{k}", F.when(shapes.isNotNull() & (F.size(kinds) <= _SHAPES), F.transform(F.filter(kinds, lambda s: s.isNotNull()), one)).otherwise(alone))
    none = F.array().cast(_MEMBERS)

    def held(e: Column) -> Column:
        entries = F.map_entries(F.try_variant_get(e["v"], "$", "map<string,variant>"))
        own = F.transform(entries, lambda m: F.struct(F.concat(F.lit(prefix), m["key"]).alias("field"), F.schema_of_variant(m["value"]).alias("type"), e["n"].alias("n")))
        return F.coalesce(own, none)

    members.append(F.coalesce(F.flatten(F.transform(f"_found_{k}", held)), none))
    for f in schema.fields:
        inner = _element(f.dataType)
        if not (nested and isinstance(inner, T.StructType)):
            continue
        below, t = F.transform(values, _member_of(f.name)), f.dataType
        while isinstance(t, T.ArrayType):
            below = F.flatten(F.transform(below, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))))
            t = t.elementType
        rows = rows.withColumn(f"_values_{len(members)}", below)
        rows = _with_members(rows, inner, f"{prefix}{f.name}.", nested, members)
    return rows


def _member_of(name: str) -> Callable[[Column], Column]:
    return lambda value: F.try_variant_get(value, f'$["{name}"]', "variant")


# ---------------------------------------------------------------- several versions in force


def in_force(history: DataFrame, subject: str) -> dict[int, T.StructType]:
    """All versions of a subject that are not retired, looked up once on the driver: a few rows."""
    rows = history.filter((F.col("subject") == subject) & ~F.col("retired")).select("version", "schema_json").collect()
    return {r["version"]: struct_of_avro(r["schema_json"]) for r in rows}


def with_violations_by_version(
    rows: DataFrame, image: str, schema: T.StructType, versions: Mapping[int, T.StructType], version: str, name: str = "violations"
) -> DataFrame:
    """As :func:`with_violations`, each row against the version it names, or ``schema`` if it names none.

    A version sees only the images that name it, so a row is checked once, however many versions there are. A row that
    names a version that is not in force has no violations: it is for the caller to refuse it.
    """
    checked, found = rows, []
    for k, (number, own) in enumerate([(None, schema), *sorted(versions.items())]):
        named = F.col(version).isNull() if number is None else F.col(version) == number
        checked = checked.withColumn(f"_image_{k}", F.when(named, F.col(image)))
        checked = with_violations(checked, f"_image_{k}", own, f"_found_{k}")
        found.append(F.col(f"_found_{k}"))
    return checked.select(*rows.columns, F.coalesce(*found).alias(name))
