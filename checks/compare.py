"""Runs registered queries on Spark and their SQL on DuckDB and compares whole results."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type name -> DuckDB type name
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None if columns, types and the multiset of rows agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = con.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in found.description}
    if columns != sorted(types):
        return f"columns {columns} vs {sorted(types)}"
    wrong = {c: (t, types[c]) for c, t in df.dtypes if _TYPES[t] != types[c]}
    if wrong:
        return f"types {wrong}"
    order = [d[0] for d in found.description]
    expected = Counter(_row(dict(zip(order, r, strict=True)), columns) for r in found.fetchall())
    actual = Counter(_row(r.asDict(), columns) for r in df.collect())
    if expected == actual:
        return None
    return f"{sum(actual.values())} vs {sum(expected.values())} rows; only here {list((actual - expected).items())[:3]}; " \
           f"only there {list((expected - actual).items())[:3]}"


def _row(values: dict, columns: list[str]) -> tuple:
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in (values[c] for c in columns))


def main(sf_dir: str, *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            diff = difference(spark, con, name, sf_dir) if name in ORACLES else "no SQL"
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {'same' if diff is None else diff[:900]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
