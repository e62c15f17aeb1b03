"""Queries over well-log samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted, rescale, rounded

# Axis ranges of the neutron and density curves and of the gamma-ray track.
NEUTRON, DENSITY = (0.45, -0.15), (1.95, 2.95)
GAMMA_MIN, GAMMA_MAX, GAMMA_BANDS = 0.0, 150.0, 100


def per_well(logs: DataFrame, label: str) -> DataFrame:
    """Samples and distinct labels per well."""
    counts = logs.groupBy("WELL", quoted(label)).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("WELL").agg(
        F.sum("_n").alias("n_samples"), F.count(quoted(label)).alias("n_labels"))


def label_balance(logs: DataFrame, label: str) -> DataFrame:
    """Samples per split and label."""
    return logs.groupBy("dataset", quoted(label)).agg(F.count(F.lit(1)).alias("n_samples"))


def mean_curves(logs: DataFrame, curves: list[str], decimals: int | None = 2) -> DataFrame:
    """Samples and curve means per well, rounded unless ``decimals`` is None."""
    return logs.groupBy("WELL").agg(F.count(F.lit(1)).alias("n_samples"), *[
        rounded(F.sum(quoted(c)).cast("double") / F.nullif(F.count(quoted(c)), F.lit(0)), decimals)
        .alias(f"mean_{c}") for c in curves])


def formation_samples(logs: DataFrame) -> DataFrame:
    """Samples per well and named formation."""
    return logs.where(F.col("FORMATION").isNotNull()).groupBy("WELL", "FORMATION").agg(
        F.count(F.lit(1)).alias("n_samples"))


def log_window(logs: DataFrame, curves: list[str], well: Column | str | None = None,
               top: float | None = None, base: float | None = None) -> DataFrame:
    """Chosen curves of a depth window, in no order; samples with none of them are dropped."""
    if well is not None:
        logs = logs.where(F.col("WELL") == (F.lit(well) if isinstance(well, str) else well))
    if top is not None:
        logs = logs.where(F.col("DEPTH_MD") >= top)
    if base is not None:
        logs = logs.where(F.col("DEPTH_MD") <= base)
    chosen = logs.select("WELL", "DEPTH_MD", *[quoted(c) for c in curves])
    return chosen.dropna("all", subset=curves)


def density_neutron(logs: DataFrame) -> DataFrame:
    """Neutron porosity mapped onto the density axis, and which side the density lies on."""
    mapped = rescale(F.col("NPHI"), *NEUTRON, *DENSITY)
    return logs.withColumn("nphi_mapped", mapped).withColumn(
        "is_shale", F.col("RHOB") >= F.col("nphi_mapped")).withColumn(
        "is_sand", F.col("RHOB") <= F.col("nphi_mapped"))


def gamma_band(logs: DataFrame) -> DataFrame:
    """The highest gamma-ray band whose floor is not above the reading; none below the axis."""
    step = F.lit((GAMMA_MAX - GAMMA_MIN) / GAMMA_BANDS)
    reading = F.col("GR") - F.lit(GAMMA_MIN)
    index = F.floor(reading / step)
    # The quotient may round up to a floor that lies just above the reading.
    index = F.when(index * step > reading, index - 1).otherwise(index)
    return logs.withColumn("gr_band", F.when(
        reading >= 0, F.least(index, F.lit(GAMMA_BANDS - 1)).cast("int")))
