"""The corpus pipeline: quality rules, near-dedup, personal data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, near, packing, pii, quality
from tidemark.llm.frames import Scratch

STAGES = [
    ("quality rules", quality.stage),
    ("near-dedup", near.stage),
    ("personal data", pii.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

# The stages are fitted models and searches that SQL does not express; they are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.table(docs, name.replace(" ", "-"))
    return docs
