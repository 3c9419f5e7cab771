"""Merges that rewrite only what the changes touch: a target with one folder per value of a column.

A day's merge writes the new content of the folders its changes touch below its own name, and then one row per such folder
to the table of versions; a folder's newest version is what it holds. Other folders are neither read nor written, a run that dies
leaves no version, one that is repeated replaces its own files, and readers keep the versions they began with until these expire.

A folder is touched if a change has its value, or if it holds the key of a change: a row whose value changes leaves one folder and
turns up in the other. Where the column belongs to the key only the first can be, and nothing outside these folders is looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge
from tidemark.operators.changes import latest
from tidemark.operators.merge import quoted
from tidemark.plans import merging
from tidemark.plans.deadletters import Letters
from tidemark.sources import batches

FOLDER = "_folder"
VERSIONS_SCHEMA = f"{FOLDER} string, day string, n bigint"


@dataclass(frozen=True)
class FolderTarget:
    """The last change of every key, deletes included, in folders by the column ``by``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    by: str

    def folder(self) -> Column:
        """The folder of a row; null and the text ``null`` share one."""
        return F.coalesce(F.col(f"`{self.by}`").cast("string"), F.lit("null"))

    def versions(self, before: str | None = None) -> DataFrame:
        """The version each folder is in, or was in before a day: ``(_folder, day, n)``."""
        rows = batches.read(self.spark, f"{self.path}/versions", VERSIONS_SCHEMA)
        if before is not None:
            rows = rows.filter(F.col("day") < before)
        return rows.groupBy(FOLDER).agg(F.max("day").alias("day"), F.max_by("n", "day").alias("n"))

    def state(self, before: str | None = None, folders: DataFrame | None = None) -> DataFrame:
        """All rows, or those of some ``folders``. Only the folders that are asked for are listed and read."""
        wanted = self.versions(before).filter("n > 0")
        if folders is not None:
            wanted = wanted.join(folders.select(FOLDER).distinct(), FOLDER, "left_semi")
        paths = [self._place(r["day"], r[FOLDER]) for r in wanted.collect()]  # one per folder
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rows(self) -> DataFrame:
        """The rows that exist."""
        return merge.live(self.state(), self.order)

    def _place(self, day: str, folder: str) -> str:
        return f"{self.path}/data/{batches.BATCH}={day}/{FOLDER}={self._escaped(folder)}"

    def _escaped(self, folder: str) -> str:
        """As the writer names a partition's folder."""
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(folder)


def merge_changes(target: FolderTarget, changes: DataFrame, day: str, keep_deletes_us: int | None = None) -> None:
    """Merges changes into the target as it was before ``day``: the last change of every key wins.

    The reduced changes are stored first, so Spark knows their size when it plans the joins: small ones are broadcast, and the
    rows of the touched folders are read and written where they are.
    """
    spark, keys, order, path = target.spark, target.keys, target.order, target.path
    batches.append(latest(changes.select(*quoted(target.schema.fieldNames())), keys, order), f"{path}/staged", day)
    staged = batches.exact(spark, f"{path}/staged", day, target.schema)
    touched = staged.select(target.folder().alias(FOLDER))
    if target.by not in keys:
        held = target.state(before=day).select(*quoted(dict.fromkeys([*keys, target.by])))
        held = held.join(staged.select(*quoted(keys)).distinct(), list(keys), "left_semi")
        touched = touched.unionByName(held.select(target.folder().alias(FOLDER)))
    batches.append(touched.distinct().coalesce(1), f"{path}/touched", day)
    touched = spark.read.schema(f"{FOLDER} string").parquet(f"{path}/touched/{batches.BATCH}={day}")
    merged = merge.fold(target.state(before=day, folders=touched), staged, keys, order)
    if keep_deletes_us is not None:
        merged = merging.without_old_deletes(merged, staged, order[0], keep_deletes_us)
    written = f"{path}/data/{batches.BATCH}={day}"
    merged.withColumn(FOLDER, target.folder()).write.mode("overwrite").partitionBy(FOLDER).parquet(written)
    stored = spark.read.schema(T.StructType([*target.schema.fields, T.StructField(FOLDER, T.StringType())])).parquet(written)
    counts = stored.groupBy(FOLDER).agg(F.count("*").alias("n"))  # from the files' footers
    version = touched.join(counts, FOLDER, "left_outer").select(FOLDER, F.lit(day).alias("day"), F.coalesce("n", F.lit(0)).alias("n"))
    batches.append(version.coalesce(1), f"{path}/versions", day)


def merge_day(
    target: FolderTarget,
    raw_path: str,
    run_date: str,
    fmt: str = "parquet",
    keep_deletes_us: int | None = None,
    dead: Letters | None = None,
) -> None:
    """Merges the raw folder of the day before the run; text rows that do not fit go to ``dead``."""
    merge_changes(target, merging.day_rows(target, raw_path, run_date, fmt, dead), run_date, keep_deletes_us)


def expire(target: FolderTarget, keep: int = 2) -> int:
    """Scheduled: of every folder all but its newest ``keep`` versions go; returns how many went."""
    if keep < 1:
        raise ValueError("the newest version of a folder is the target")
    spark, path = target.spark, target.path
    rows = batches.read(spark, f"{path}/versions", VERSIONS_SCHEMA)
    days = rows.groupBy(FOLDER).agg(F.slice(F.sort_array(F.collect_set("day"), asc=False), keep + 1, 1 << 30).alias("old"))
    gone = rows.join(days, FOLDER).filter(F.array_contains("old", F.col("day"))).select(FOLDER, "day", "n")
    places = [(r[FOLDER], r["day"]) for r in gone.collect()]  # one per folder and day
    if places:
        old = batches.names(spark, f"{path}/versions")
        kept = rows.join(days, FOLDER).filter(~F.array_contains("old", F.col("day"))).select(*rows.columns)
        batches.rewrite(kept.coalesce(1), f"{path}/versions", old)
        for folder, day in places:
            batches.delete(spark, target._place(day, folder))
    return len(places)
