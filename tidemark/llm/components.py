"""Connected components of an edge table, by alternating star contractions; all steps are joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import Scratch

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins each node's larger neighbours to its smallest one; edges run from the larger node to the smaller."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); a component is called by its smallest node.

    Nodes are of any ordered type. Each round is one table; it ends when a round changes nothing.
    """
    pair = F.col("a") > F.col("b")
    first = edges.filter(F.col("a") != F.col("b")).select(
        F.when(pair, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(pair, F.col("b")).otherwise(F.col("a")).alias("b")
    )
    stars, seen = scratch.table(first.distinct(), f"{name}0"), None
    for k in range(1, MAX_ROUNDS + 1):
        last = f"{name}{k}"
        stars = scratch.table(_small_star(_large_star(stars).distinct()).distinct(), last)
        mark = stars.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        scratch.drop(f"{name}{k - 1}")
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
    else:
        raise RuntimeError("the components did not settle")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
