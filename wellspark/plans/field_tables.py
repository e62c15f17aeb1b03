"""Field tables from raw daily and monthly sheets (read as CSV or Parquet)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.contracts import (
    FIELD_DAILY,
    FIELD_DAILY_MAPPING,
    FIELD_MONTHLY,
    FIELD_MONTHLY_MAPPING,
    FIELD_WELLS,
    FIELD_WELLS_MAPPING,
    conform,
)
from wellspark.functions.columns import month_of, quoted


def load_mapped(df: DataFrame, mapping: dict[str, str],
                transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Select and rename columns by a mapping, then apply an optional step."""
    renamed = df.select([quoted(src).alias(out) for src, out in mapping.items()])
    return transform(renamed) if transform else renamed


def as_number(column: Column) -> Column:
    """A number from text; NULL where the text is none."""
    return F.trim(column.cast("string")).try_cast("double")


def field_wells(daily: DataFrame) -> DataFrame:
    """Distinct well attributes found in the daily sheet."""
    return conform(load_mapped(daily, FIELD_WELLS_MAPPING).dropDuplicates(), FIELD_WELLS)


def as_date(column: Column) -> Column:
    """A date from a date, a time or ISO text; NULL where the text is none."""
    return F.trim(column.cast("string")).try_cast("timestamp_ntz").cast("date")


def field_daily(daily: DataFrame) -> DataFrame:
    """Daily facts with a real date; a sheet may have it as text."""
    facts = load_mapped(daily, FIELD_DAILY_MAPPING, lambda df: df.withColumn("date", as_date(F.col("date"))))
    return conform(facts, FIELD_DAILY)


def field_monthly(monthly: DataFrame) -> DataFrame:
    """Monthly facts: units row and keyless rows dropped, text coerced, year and month joined.

    The units row is known by its content (its year is no number), not by its position.
    """
    year, month = as_number(F.col("Year")), as_number(F.col("Month"))
    numbers = monthly.where(year.isNotNull()).select(
        month_of(year, month).alias("date"),
        *[as_number(quoted(src)).alias(out) for src, out in FIELD_MONTHLY_MAPPING.items()])
    return conform(numbers.where(F.col("npd_wellbore_code").isNotNull()), FIELD_MONTHLY)
