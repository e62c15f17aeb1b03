"""Queries over the field tables: wells, daily production, monthly production."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import month_start, rounded
from wellspark.operators.quantiles import exact_quantiles
from wellspark.operators.slices import dealt_by
from wellspark.session import keep
from wellspark.operators.rollup import sums_by_dimension, top

CODE, NAME = "npd_wellbore_code", "wellbore_name"
VOLUMES = ["oil_volume", "gas_volume", "water_volume"]


def _double(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in columns]


def daily_totals(daily: DataFrame) -> DataFrame:
    """Field volumes per day over rows that report all three."""
    whole = daily.dropna("any", subset=VOLUMES)
    return whole.groupBy("date").agg(
        *[F.sum(v).cast("double").alias(f"total_{v.split('_')[0]}") for v in VOLUMES])


def cumulative_totals(daily: DataFrame) -> DataFrame:
    """Field volumes over all days, in one row."""
    return daily.dropna("any", subset=VOLUMES).agg(
        *[F.sum(v).cast("double").alias(f"total_{v.split('_')[0]}") for v in VOLUMES])


def cumulative_oil(daily: DataFrame, wells: DataFrame) -> DataFrame:
    """Oil per well name."""
    reported = daily.where(F.col("oil_volume").isNotNull())
    return sums_by_dimension(reported, wells, CODE, ["oil_volume"], by_dimension=[NAME]).select(
        NAME, F.col("oil_volume").cast("double").alias("cumulative_oil"))


def leading_wells(daily: DataFrame, wells: DataFrame, n: int = 15) -> DataFrame:
    return top(cumulative_oil(daily, wells), n, F.col("cumulative_oil"), NAME)


def liquid_shares(daily: DataFrame) -> DataFrame:
    """Oil and water as shares of the field's liquids."""
    totals = cumulative_totals(daily)
    liquids = F.col("total_oil") + F.col("total_water")
    return totals.select((F.col("total_oil") / liquids).alias("oil_share"),
                         (F.col("total_water") / liquids).alias("water_share"))


def joined_history(daily: DataFrame, wells: DataFrame) -> DataFrame:
    """Daily volumes with well names, all wells and days.

    A join without an aggregate: Spark broadcasts the wells when they are small enough by its
    own size check and otherwise splits skewed join partitions at run time.
    """
    return daily.join(wells.select(CODE, NAME), CODE).select(NAME, "date", *VOLUMES)


def first_days(daily: DataFrame, wells: DataFrame, name: Column, n: int = 10) -> DataFrame:
    """The first days of the well of that name."""
    chosen = wells.where(F.col(NAME) == name)
    return joined_history(daily, chosen).orderBy("date", NAME, *VOLUMES).limit(n)


def monthly_rollup(daily: DataFrame) -> DataFrame:
    """Daily volumes summed per well and month."""
    return daily.groupBy(CODE, F.date_format(month_start(F.col("date")), "yyyy-MM")
                         .alias("year_month")).agg(
        *[F.sum(v).cast("double").alias(f"total_{v.split('_')[0]}") for v in VOLUMES])


def production_summary(daily: DataFrame, wells: DataFrame,
                       decimals: int | None = 2) -> DataFrame:
    """Per well name: producing days, totals, mean daily oil; wells without data included."""
    per_day = daily.groupBy(CODE, "date").agg(
        F.sum("oil_volume").alias("_oil"), F.count("oil_volume").alias("_n"),
        F.sum("gas_volume").alias("_gas"))
    # Days are counted per name, so two codes of one name share a day.
    named = wells.select(CODE, NAME).join(per_day, CODE, "left").groupBy(NAME, "date").agg(
        F.sum("_oil").alias("_oil"), F.sum("_n").alias("_n"), F.sum("_gas").alias("_gas"))
    return named.groupBy(NAME).agg(
        F.count("date").alias("days_producing"),
        rounded(F.sum("_oil"), decimals).cast("double").alias("total_oil"),
        rounded(F.sum("_gas"), decimals).cast("double").alias("total_gas"),
        rounded(F.sum("_oil").cast("double") / F.nullif(F.sum("_n"), F.lit(0)), decimals)
        .alias("avg_daily_oil"))


def top_days(daily: DataFrame, wells: DataFrame, n: int = 10) -> DataFrame:
    """The days with the most oil; every task keeps its best ``n`` rows and passes on no more."""
    named = joined_history(daily.where(F.col("oil_volume").isNotNull()), wells)
    return top(named, n, F.col("oil_volume"), "date", NAME, "gas_volume").select(
        NAME, "date", *_double(named, ["oil_volume", "gas_volume"]))


def wells_of_type(daily: DataFrame, wells: DataFrame, well_type: str = "WI") -> DataFrame:
    """Distinct wells that ever had a type, such as water injection."""
    pairs = daily.where(F.col("well_type") == well_type).select(CODE, "well_type").distinct()
    return pairs.join(wells.select(CODE, NAME), CODE).select(NAME, "well_type").distinct()


def yearly_production(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.date_format("date", "yyyy").alias("year")).agg(
        *[F.round(F.sum(v), 2).cast("double").alias(f"total_{v.split('_')[0]}")
          for v in VOLUMES])


def well_comparison(daily: DataFrame, wells: DataFrame, year: int) -> DataFrame:
    """Days, oil and gas per well name in one year."""
    in_year = daily.where((F.year("date") == year) & F.col("oil_volume").isNotNull()).withColumn(
        "_days", F.lit(1))
    return sums_by_dimension(in_year, wells, CODE, ["_days", "oil_volume", "gas_volume"],
                             by_dimension=[NAME]).select(
        NAME, F.col("_days").alias("days_active"),
        F.round("oil_volume", 2).cast("double").alias("oil"),
        F.round("gas_volume", 2).cast("double").alias("gas"))


def monthly_trend(monthly: DataFrame, wells: DataFrame) -> DataFrame:
    """Reported monthly volumes with well names, in no order.

    A detail join on the well's code: Spark's adaptive skew handling splits a hot well.
    """
    volumes = ["oil_volume_sm3", "gas_volume_sm3", "water_volume_sm3"]
    reported = monthly.where(F.col("oil_volume_sm3").isNotNull())
    return reported.join(wells.select(CODE, NAME), CODE).select(
        NAME, "date", *volumes)


def daily_against_monthly(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """Per well and month: daily volumes summed, the reported figure, and the difference.

    Months that only one side has are kept. Rows of both sides are dealt out by well and month
    once, to tasks of a bounded number of rows that add them up.
    """
    days = daily.select(CODE, month_start(F.col("date")).alias("date"), F.col("oil_volume").alias("daily_oil"),
                        F.col("gas_volume").alias("daily_gas"))
    months = monthly.select(CODE, "date", F.col("oil_volume_sm3").alias("monthly_oil"), F.col("gas_volume_sm3").alias("monthly_gas"))
    both = dealt_by(days.unionByName(months, allowMissingColumns=True), F.col(CODE), F.col("date"))
    sums = both.groupBy(CODE, "date").agg(*[
        F.sum(f"{side}_{v}").alias(f"{side}_{v}") for v in ("oil", "gas") for side in ("daily", "monthly")])
    kinds = dict(sums.dtypes)
    sides = sums.withColumns({f"monthly_{v}": F.col(f"monthly_{v}").cast(kinds[f"daily_{v}"]) for v in ("oil", "gas")})
    return sides.withColumn("oil_difference", F.col("daily_oil") - F.col("monthly_oil")).withColumn(
        "gas_difference", F.col("daily_gas") - F.col("monthly_gas"))


def well_summary(daily: DataFrame) -> DataFrame:
    """Totals and rows per well code over rows that report oil."""
    return daily.where(F.col("oil_volume").isNotNull()).groupBy(CODE).agg(
        F.sum("oil_volume").cast("double").alias("total_oil"),
        F.sum("gas_volume").cast("double").alias("total_gas"),
        F.count("date").alias("days_producing"))


def oil_statistics(daily: DataFrame, wells: DataFrame) -> DataFrame:
    """Sum, mean and exact median of daily oil per well name.

    Equal volumes are counted per code once; sums, rows and median all follow from the counts.
    """
    counts = daily.where(F.col("oil_volume").isNotNull()).groupBy(CODE, "oil_volume").agg(F.count(F.lit(1)).alias("_n"))
    named = keep(counts.join(wells.select(CODE, NAME), CODE).groupBy(NAME, "oil_volume").agg(F.sum("_n").alias("_n")))
    sums = named.groupBy(NAME).agg(F.sum(F.col("oil_volume") * F.col("_n")).alias("_oil"), F.sum("_n").alias("_rows"))
    medians = exact_quantiles(named, [NAME], "oil_volume", {"median_oil": 0.5}, "_n")
    return sums.join(medians, NAME).select(
        NAME, F.col("_oil").cast("double").alias("total_oil"),
        (F.col("_oil").cast("double") / F.col("_rows")).alias("avg_oil"), "median_oil")
