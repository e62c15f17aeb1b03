"""Reading raw and published tables."""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.functions.columns import quoted
from wellspark.sources.files import exists, first_lines, list_files, read_manifest
from wellspark.sources.zones import ZONES, scan_zones


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header whose columns are those of the schema, in its order; others are refused.

    ``multi_line`` allows line breaks inside quoted cells, and makes each file one task.
    """
    return (spark.read.option("header", True).option("enforceSchema", False).option("multiLine", multi_line)
            .option("escape", '"').schema(schema).csv(path))


def _headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header; folders stand for their files. Only the first block of a file is read."""
    listed = spark.read.format("binaryFile").load(paths).where("length > 0").select("path").orderBy("path")
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in first_lines(spark, [r["path"] for r in listed.collect()]).items():
        groups.setdefault(tuple(next(csv.reader([line]))), []).append(path)
    return groups


def read_csv_by_name(spark: SparkSession, paths: list[str], schema: T.StructType,
                     multi_line: bool = False) -> DataFrame:
    """CSV files whose headers may differ in columns and order; columns are matched by name.

    Only the first block of each file is looked at beforehand. Files with the same header are read together,
    the groups are united by name, and columns a file lacks are NULL. Columns outside the schema
    are dropped and no type is inferred. A folder may mix headers.
    """
    groups = _headers(spark, paths)
    if not groups:
        return spark.createDataFrame([], schema)
    types = {f.name: f.dataType for f in schema}
    parts = []
    for header, files in groups.items():
        layout = T.StructType([T.StructField(h, types.get(h, T.StringType())) for h in header])
        parts.append(read_csv(spark, files, layout, multi_line).select(
            *[quoted(h) for h in header if h in types]))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    absent = [F.lit(None).cast(types[n]).alias(n) for n in types if n not in united.columns]
    return united.select("*", *absent).select(*[quoted(n) for n in types])


def read_parquet_with_path(spark: SparkSession, *paths: str, by_name: bool = False) -> DataFrame:
    """Parquet rows with the path of their file; ``by_name`` fills columns a file lacks."""
    reader = spark.read.option("mergeSchema", by_name)
    return reader.parquet(*paths).select("*", F.col("_metadata.file_path").alias("file_path"))


def read_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """A partitioned table; filters on the partition column skip its folders."""
    return spark.read.parquet(root)


def read_leaf(spark: SparkSession, root: str, partition: str) -> DataFrame:
    """The files of one partition folder alone, without the partition column."""
    return spark.read.parquet(f"{root}/{partition}")


def in_years(first: int, last: int, column: str = "year") -> Callable[[str], bool]:
    """Keeps manifest entries of the partitions ``first`` to ``last``."""
    wanted = {f"{column}={y}" for y in range(first, last + 1)}
    return lambda entry: entry.split("/", 1)[0] in wanted


def with_prefix(*prefixes: str) -> Callable[[str], bool]:
    return lambda entry: entry.startswith(prefixes)


def without(*names: str) -> Callable[[str], bool]:
    return lambda entry: entry not in names


def scan_manifest(spark: SparkSession, root: str,
                  keep: Callable[[str], bool] | None = None) -> DataFrame:
    """Read exactly the files the manifest lists, or those of them that ``keep`` accepts."""
    entries = [e for e in read_manifest(spark, root) if keep is None or keep(e)]
    if not entries:
        raise FileNotFoundError(f"no manifest entry of {root} is wanted")
    return spark.read.option("basePath", root).parquet(*[f"{root}/{e}" for e in entries])


def one_entity(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one entity; the filter reaches the file scan."""
    return df.where(quoted(column) == F.lit(value))


def instance_rows(catalog: DataFrame, instance_id: str) -> DataFrame:
    """Rows of one instance, read from the addresses that the catalog has for it.

    Where instances share files there is no folder at an address: the zone map then names the
    files that cover the instance.
    """
    spark = catalog.sparkSession
    found = catalog.where(F.col("instance_id") == instance_id).select("source_url", "event_class").distinct()
    # One address per event class.
    classes = {r["source_url"]: r["event_class"] for r in found.collect()}
    addresses = list(classes)
    if not addresses:
        raise FileNotFoundError(f"the catalog has no instance {instance_id}")
    root = addresses[0].rsplit("/event_class=", 1)[0]
    if exists(spark, f"{root}/{ZONES}"):
        shared = scan_zones(spark, root, "instance_id", "timestamp", (instance_id, instance_id))
        return shared.where(F.col("event_class").isin(list(classes.values())))
    return spark.read.option("basePath", root).parquet(*addresses).drop("instance")


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    return list_files(spark, root)
