"""Landing: events -> row images -> flat rows -> raw zone of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import FeedConfig
from tidemark.operators.envelope import OK, typed, valid
from tidemark.operators.flatten import flatten
from tidemark.sources import rawzone


# what a raw row has besides its fields: the operation, the event's time, and its place in the topic
_ORDER = {"op": "string", "ts_ms": "bigint", "ts_us": "bigint", "ts_ns": "bigint", "msg_partition": "int", "msg_offset": "bigint"}


def outcome(classified: DataFrame, cfg: FeedConfig, raw: Column) -> DataFrame:
    """What both sinks need of a classified event and no more, so that it is cheap to keep.

    A good event is its typed row image, a faulty one its raw text.
    """
    good = F.col("reason") == OK
    row = F.try_variant_get("image", "$", typed(cfg.row_schema))
    return classified.select(
        rawzone.DAY, "reason", F.when(~good, raw).alias("raw"), F.when(good, row).alias("_row"), *_ORDER
    )


def flat_rows(outcomes: DataFrame) -> DataFrame:
    """Flat raw rows of the good events."""
    return flatten(valid(outcomes).select(rawzone.DAY, "_row.*", *_ORDER))


def raw_schema(spark: SparkSession, cfg: FeedConfig) -> T.StructType:
    """Schema of the raw rows of a feed, without the day."""
    if clash := {f.name.lower() for f in cfg.row_schema.fields} & set(_ORDER):
        raise ValueError(f"the row has fields with names of the raw zone: {sorted(clash)}")
    order = T._parse_datatype_string(", ".join(f"{name} {kind}" for name, kind in _ORDER.items()))
    return flatten(spark.createDataFrame([], T.StructType([*cfg.row_schema.fields, *order.fields]))).schema
