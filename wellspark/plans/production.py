"""Queries over the well master and the monthly production series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import two_way_bucket
from wellspark.functions.units import SI, Units
from wellspark.operators.profile import distinct_per_entity, histogram, value_counts
from wellspark.operators.rollup import sums_by_dimension, top
from wellspark.operators.temporal import gap_audit

# The resource type that makes a well unconventional, and the two bucket names.
UNCONVENTIONAL, UNCONV, OTHER = "NO CONVENCIONAL", "Unconv", "Other"
# Fixed value: basins with less cumulative oil than this (source units) are not ranked.
MIN_BASIN_OIL = 1e6


def with_bucket(wells: DataFrame) -> DataFrame:
    return wells.withColumn(
        "bucket", two_way_bucket(F.col("tipo_recurso"), UNCONVENTIONAL, UNCONV, OTHER))


def _by_bucket(monthly: DataFrame, wells: DataFrame, measure: str) -> DataFrame:
    return sums_by_dimension(monthly, with_bucket(wells), "idpozo", [measure],
                             by_fact=["fecha"], by_dimension=["bucket"])


def oil_by_bucket(monthly: DataFrame, wells: DataFrame, units: Units = SI) -> DataFrame:
    """Oil per month and resource bucket, as volumes or as daily rates."""
    return _by_bucket(monthly, wells, "prod_pet").select(
        "fecha", "bucket", units.oil(F.col("prod_pet"), F.col("fecha")).alias(units.oil_column))


def gas_by_bucket(monthly: DataFrame, wells: DataFrame, units: Units = SI) -> DataFrame:
    return _by_bucket(monthly, wells, "prod_gas").select(
        "fecha", "bucket", units.gas(F.col("prod_gas"), F.col("fecha")).alias(units.gas_column))


def stacked_series(by_bucket: DataFrame, value: str, scale: float = 1.0) -> DataFrame:
    """One row per month with a column per bucket; a bucket absent in a month is 0."""
    return by_bucket.groupBy("fecha").pivot("bucket", [OTHER, UNCONV]).agg(
        F.sum(value) / F.lit(scale)).fillna(0.0, [OTHER, UNCONV])


def locations(wells: DataFrame, lon: tuple[float, float], lat: tuple[float, float]) -> DataFrame:
    """Wells inside a box, with their bucket."""
    inside = wells.where(F.col("coordenadax").between(*lon) & F.col("coordenaday").between(*lat))
    return with_bucket(inside).select(
        F.col("coordenadax").alias("lon"), F.col("coordenaday").alias("lat"), "bucket")


def top_basins(monthly: DataFrame, wells: DataFrame, units: Units = SI, n: int = 6) -> DataFrame:
    """Basins by cumulative oil, gas beside it."""
    named = wells.where(F.col("cuenca").isNotNull())
    totals = sums_by_dimension(monthly, named, "idpozo", ["prod_pet", "prod_gas"],
                               by_dimension=["cuenca"]).where(F.col("prod_pet") > MIN_BASIN_OIL)
    return top(totals, n, F.col("prod_pet"), "cuenca").select(
        "cuenca", units.oil_total(F.col("prod_pet")).alias(units.oil_total_column),
        units.gas_total(F.col("prod_gas")).alias(units.gas_total_column))


def relative_to_leader(ranked: DataFrame, values: list[str]) -> DataFrame:
    """Add each value's share of the largest one. ``ranked`` is a short top-n list."""
    leaders = ranked.agg(*[F.max(v).alias(v) for v in values])
    return ranked.select("*", *[
        (F.col(v) / leaders.select(v).scalar()).alias(f"{v}_share") for v in values])


def yearly_totals(monthly: DataFrame, measures: list[str], first: int | None = None,
                  last: int | None = None) -> DataFrame:
    """Sums per year, optionally of a range of years.

    The range is put on the date, and on the partition column where there is one.
    """
    if first is not None and last is not None:
        monthly = monthly.where(F.col("fecha").between(
            F.make_date(F.lit(first), F.lit(1), F.lit(1)),
            F.make_date(F.lit(last), F.lit(12), F.lit(31))))
        if "year" in monthly.columns:
            monthly = monthly.where(F.col("year").between(first, last))
    return monthly.groupBy(F.year("fecha").alias("anio")).agg(
        *[F.sum(m).cast("double").alias(m) for m in measures])


def active_wells(monthly: DataFrame) -> DataFrame:
    """Distinct wells with a row in each year."""
    pairs = monthly.select(F.year("fecha").alias("anio"), "idpozo").distinct()
    return pairs.groupBy("anio").agg(F.count("idpozo").alias("n_wells"))


def wells_per(wells: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The values of an attribute with the most wells."""
    return top(value_counts(wells, column, "n_wells"), n, F.col("n_wells"), column)


def change_distribution(production: DataFrame, column: str, most: int = 20) -> DataFrame:
    """Histogram of how many distinct values of a column a well ever had."""
    return histogram(distinct_per_entity(production, "idpozo", column), "n_values", most=most)


def gap_distribution(months: DataFrame, metric: str = "gap_count", bins: int = 30) -> DataFrame:
    """Histogram of a gap-audit metric over wells; ``months`` has idpozo and fecha."""
    return histogram(gap_audit(months, "idpozo", "fecha"), metric, bins)


def located_wells(listing: DataFrame) -> DataFrame:
    return listing.select("coordenadax", "coordenaday").dropna("any")


def basin_totals(monthly: DataFrame, wells: DataFrame, year: int) -> DataFrame:
    """Oil and gas per basin in one year."""
    in_year = monthly.where(F.year("fecha") == year)
    if "year" in monthly.columns:
        in_year = in_year.where(F.col("year") == year)
    totals = sums_by_dimension(in_year, wells, "idpozo", ["prod_pet", "prod_gas"],
                               by_dimension=["cuenca"])
    return totals.select("cuenca", *[
        F.col(c).cast("double").alias(c) for c in ("prod_pet", "prod_gas")])


def leading_well(monthly: DataFrame):
    """The id of the well with the most oil, as a scalar subquery."""
    totals = monthly.groupBy("idpozo").agg(F.sum("prod_pet").alias("_total"))
    return top(totals, 1, F.col("_total"), "idpozo").select("idpozo").scalar()
