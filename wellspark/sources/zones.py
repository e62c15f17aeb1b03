"""Zone map of a published table: what each file covers, so that a reader opens only files it needs.

The map is a small Parquet table beside the files (``_zones``): the file's path below the root,
the smallest and largest entity and time in it, its rows and its bytes.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted
from wellspark.sources.files import qualified_path

ZONES = "_zones"


def zones_of(spark: SparkSession, root: str, entity: str, time: str) -> DataFrame:
    """One row per file, from one aggregate over the entity and time columns of the files."""
    marker = qualified_path(spark, root).rstrip("/") + "/"
    return (spark.read.parquet(root)
            .groupBy(F.substring_index("_metadata.file_path", marker, -1).alias("path"), F.col("_metadata.file_size").alias("bytes"))
            .agg(F.min(quoted(entity)).alias("first_entity"), F.max(quoted(entity)).alias("last_entity"),
                 F.min(quoted(time)).alias("first_time"), F.max(quoted(time)).alias("last_time"), F.count(F.lit(1)).alias("rows"))
            .select("path", "first_entity", "last_entity", "first_time", "last_time", "rows", "bytes"))


def write_zones(spark: SparkSession, root: str, entity: str, time: str) -> None:
    zones_of(spark, root, entity, time).write.mode("overwrite").parquet(f"{root}/{ZONES}")


def read_zones(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{ZONES}")


def _covers(zones: DataFrame, of: str, first, last) -> DataFrame:
    if first is not None:
        zones = zones.where(F.col(f"last_{of}") >= F.lit(first))
    return zones if last is None else zones.where(F.col(f"first_{of}") <= F.lit(last))


def files_for(spark: SparkSession, root: str, entities: tuple = (None, None), times: tuple = (None, None)) -> list[str]:
    """Paths of the files that can hold rows of the given ranges (inclusive, None is open)."""
    zones = _covers(_covers(read_zones(spark, root), "entity", *entities), "time", *times)
    return sorted(unquote(r["path"]) for r in zones.select("path").collect())


def scan_zones(spark: SparkSession, root: str, entity: str, time: str, entities: tuple = (None, None),
               times: tuple = (None, None)) -> DataFrame:
    """Rows of a range of entities and of times (inclusive, None is open), from the files that cover them.

    Files are chosen by the map before any is listed or opened, across all partition folders; the
    ranges then filter row groups and rows of these files.
    """
    paths = files_for(spark, root, entities, times)
    if not paths:
        return spark.read.parquet(root).limit(0)
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/{p}" for p in paths])
    for column, (first, last) in ((entity, entities), (time, times)):
        if first is not None:
            rows = rows.where(quoted(column) >= F.lit(first))
        if last is not None:
            rows = rows.where(quoted(column) <= F.lit(last))
    return rows
