from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from tidemark.config import SAMPLE_ROW_SCHEMA
from tidemark.operators.flatten import flatten


def read(spark, schema, *docs):
    rows = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string")
    return rows.selectExpr(f"from_json(j, '{schema.simpleString()}') as r").select("r.*")


def test_sample_shape(spark):
    doc = {
        "id": "0042", "type": "bicycle", "name": "Harbour", "ppu": 731.25,
        "batters": {"batter": [{"id": "w-26", "type": "Front wheel"}, {"id": "w-26", "type": None}]},
        "topping": [{"id": "rack", "type": "Steel"}, {"id": "bell", "type": "Brass"}],
    }
    flat = flatten(read(spark, SAMPLE_ROW_SCHEMA, doc, {"id": "0043", "topping": []}))
    assert flat.columns == ["id", "type", "name", "ppu", "batters_ids", "batters_types", "topping_ids", "topping_types"]
    assert dict(flat.dtypes)["topping_types"] == "array<string>"
    first, second = flat.collect()
    assert first["batters_ids"] == ["w-26", "w-26"] and first["batters_types"] == ["Front wheel", None]
    assert first["topping_ids"] == ["rack", "bell"]
    assert second["batters_ids"] is None and second["topping_ids"] == []


def test_names_are_unique(spark, folder):
    schema = T.StructType.fromDDL("a_b string, a struct<b: string, B_2: string>, x array<struct<y: int>>, x_ys int, c_d struct<e: int>, c struct<d_e: int>")
    flat = flatten(spark.createDataFrame([], schema))
    assert flat.columns == ["a_b", "a_b_2", "a_B_2_2", "x_y", "x_ys", "c_d_e", "c_d_e_2"]
    flat.write.parquet(folder)
    with pytest.raises(ValueError, match="called"):
        flatten(spark.createDataFrame([], schema), rename={"a.b": "x_ys"})
    with pytest.raises(ValueError, match="called"):
        flatten(spark.createDataFrame([], schema), rename={"a.b": "n", "c.d_e": "N"})


def test_nested_structs_deep_arrays_and_clashes(spark):
    schema = T.StructType.fromDDL(
        "m struct<a: int, n: struct<a: int>>, tags array<string>, "
        "l array<struct<id: int, in: array<struct<id: int, k: array<struct<z: int>>>>>>"
    )
    doc = {
        "m": {"a": 1, "n": {"a": 2}}, "tags": ["x"],
        "l": [{"id": 1, "in": [{"id": 2, "k": [{"z": 3}]}, {"id": 4, "k": []}]}, {"id": 5, "in": None}],
    }
    flat = flatten(read(spark, schema, doc), rename={"l.in.k.z": "deep"})
    assert flat.columns == ["m_a", "m_n_a", "tags", "l_id", "l_in_id", "deep"]
    r = flat.first()
    assert (r["m_a"], r["m_n_a"], r["tags"], r["l_id"]) == (1, 2, ["x"], [1, 5])
    assert r["l_in_id"] == [[2, 4], None] and r["deep"] == [[[3], []], None]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1,)], T.StructType().add("a.b", "integer"))
    assert flatten(df).columns == ["a.b"]


def test_only_the_fields_asked_for_are_read(spark, folder):
    read(spark, SAMPLE_ROW_SCHEMA, {"id": "1", "topping": [{"id": "a", "type": "b"}]}).write.parquet(folder)
    plan = flatten(spark.read.parquet(folder)).select("topping_ids")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<topping:array<struct<id:string>>>" in plan
