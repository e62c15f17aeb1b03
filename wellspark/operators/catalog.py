"""Catalog of labelled sensor windows (instances) named by their file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted, seconds_between

# Prefixes of instance names and the kind each stands for.
KINDS = {"WELL-": "real", "SIMULATED_": "simulated", "DRAWN_": "drawn"}
# Fixed value: the label of a transient phase is the event class plus this.
TRANSIENT_OFFSET = 100
# Columns of an observation that are not sensors.
NOT_SENSORS = frozenset(
    ("class", "state", "timestamp", "instance_id", "well_id", "well_kind", "event_class"))


class NoInstances(ValueError):
    """There is nothing to build the catalog from."""


def with_provenance(df: DataFrame, path: str = "file_path") -> DataFrame:
    """Replace a file path ``.../dataset/<class>/<name>.parquet`` by what it tells.

    The path is cut at its slashes, which is cheap enough to do for every row.
    """
    def part(n: int) -> Column:
        return F.substring_index(F.substring_index(quoted(path), "/", -n), "/", 1)

    file = F.substring_index(quoted(path), "/", -1)
    name = F.substring_index(file, ".parquet", 1)
    kind = F.lit(None).cast("string")
    for prefix, label in KINDS.items():
        kind = F.when(name.startswith(prefix), label).otherwise(kind)
    return df.select(
        *[quoted(c) for c in df.columns if c != path],
        name.alias("instance_id"),
        file.alias("source_file"),
        F.when(part(3) == "dataset", part(2).try_cast("int")).alias("event_class"),
        kind.alias("well_kind"),
        F.when(name.startswith("WELL-"), F.substring_index(
            F.substr(name, F.lit(6)), "_", 1).try_cast("int")).alias("well_id"),
    )


def event_lookup(specs: DataFrame) -> DataFrame:
    """Class specs ``(event_class, name, description, has_transient)`` with derived columns."""
    return specs.select(
        "event_class", "name", "description", "has_transient",
        F.when(F.col("has_transient"), F.col("event_class") + TRANSIENT_OFFSET)
        .alias("transient_code"),
        F.col("has_transient").alias("has_normal_prefix"))


def observations(df: DataFrame, path: str = "file_path") -> DataFrame:
    """All rows with their provenance columns; lazy, nothing is stored."""
    return with_provenance(df, path).drop("source_file")


def instance_catalog(df: DataFrame, lookup: DataFrame, base_url: str,
                     path: str = "file_path") -> DataFrame:
    """One row per instance file: span, rows, rows per label phase, and published address.

    The address is the folder that ``write_observations`` gives the instance; where instances share
    files, ``readers.instance_rows`` finds the rows of an address by the zone map.

    Rows are counted per path before the path is parsed, so the expressions run once per file.
    Transient rows are NULL for classes that have no transient phase.
    """
    label, event = F.col("_label"), F.col("event_class")
    per_label = df.groupBy(quoted(path), quoted("class").alias("_label")).agg(
        F.min(quoted("timestamp")).alias("_first"), F.max(quoted("timestamp")).alias("_last"),
        F.count(F.lit(1)).alias("_n"))

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))

    per_file = (
        with_provenance(per_label, path)
        .groupBy("instance_id", "well_kind", "well_id", "event_class", "source_file")
        .agg(F.min("_first").alias("start_ts"), F.max("_last").alias("end_ts"),
             F.sum("_n").alias("n_rows"),
             rows(label.isNull()).alias("n_rows_warmup_null"),
             rows((label == 0) & (event != 0)).alias("n_rows_normal"),
             rows(label == event + TRANSIENT_OFFSET).alias("_transient"),
             rows(label == event).alias("n_rows_steady"))
    )
    # The lookup has one row per event class.
    known = lookup.select("event_class", "has_transient")
    return per_file.join(known, "event_class", "left").select(
        "instance_id", "well_kind", "well_id", "event_class", "start_ts", "end_ts",
        seconds_between(F.col("start_ts"), F.col("end_ts")).cast("long").alias("duration_s"),
        "n_rows", "n_rows_warmup_null", "n_rows_normal",
        F.when(F.col("has_transient"), F.col("_transient")).alias("n_rows_transient"),
        "n_rows_steady", "source_file",
        F.concat(F.lit(base_url.rstrip("/") + "/observations/event_class="),
                 event.cast("string"), F.lit("/instance="), F.col("instance_id"))
        .alias("source_url"))


def require_instances(df: DataFrame) -> DataFrame:
    """Raise when there is no row at all; runs one tiny job."""
    if df.isEmpty():
        raise NoInstances("no instance files found: staging may be incomplete")
    return df


def real_wells(catalog: DataFrame) -> DataFrame:
    """Master of physical wells from the catalog."""
    return catalog.where(F.col("well_kind") == "real").groupBy("well_id").agg(
        F.count(F.lit(1)).alias("n_instances"), F.min("start_ts").alias("first_ts"),
        F.max("end_ts").alias("last_ts"), F.sum("n_rows").alias("n_observations"))


def sensor_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_SENSORS]
