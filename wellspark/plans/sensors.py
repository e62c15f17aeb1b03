"""Queries over the sensor-window catalog and its observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted
from wellspark.operators.splits import assign_fold


def anomaly_classes(lookup: DataFrame) -> DataFrame:
    return lookup.where(F.col("event_class") > 0).select("name", "description", "transient_code")


def corpus_balance(catalog: DataFrame, lookup: DataFrame) -> DataFrame:
    """Instances, rows and steady rows per event class, from the catalog alone."""
    counts = catalog.groupBy("event_class").agg(
        F.count(F.lit(1)).alias("n_instances"), F.sum("n_rows").alias("n_observations"),
        F.sum("n_rows_steady").alias("n_observations_steady"))
    return counts.join(lookup.select("event_class", "description"), "event_class").select(
        "event_class", "description", "n_instances", "n_observations", "n_observations_steady")


def real_instances(catalog: DataFrame, event_class: int) -> DataFrame:
    """Instances of physical wells in one class, by start."""
    return catalog.where(
        (F.col("event_class") == event_class) & (F.col("well_kind") == "real")
    ).select("instance_id", "well_id", "start_ts", "n_rows", "source_url").orderBy(
        "start_ts", "instance_id")


def well_footprint(wells: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per well: its counts and span, and the number of event classes it appears in."""
    classes = catalog.where(F.col("well_id").isNotNull()).select(
        "well_id", "event_class").distinct().groupBy("well_id").agg(
        F.count("event_class").alias("distinct_event_classes"))
    return wells.join(classes, "well_id").select(
        "well_id", "n_instances", "n_observations", "first_ts", "last_ts",
        "distinct_event_classes")


def instance_folds(catalog: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Every instance with its fold; wells never straddle folds, others always train."""
    return assign_fold(catalog, "well_id", folds, held_out)


def class_observations(observations: DataFrame, event_class: int,
                       sensors: list[str]) -> DataFrame:
    """Rows of physical wells in one class with the chosen sensors."""
    return observations.where(
        (F.col("event_class") == event_class) & (F.col("well_kind") == "real")
    ).select("instance_id", "well_id", "timestamp", *[quoted(s) for s in sensors], "class")
