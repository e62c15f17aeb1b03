"""Column expressions shared by the operators. All run inside generated code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Placeholders that well logs carry for a missing sample.
SENTINELS = (-999.0, -999.25, -999.9)


def quoted(name: str) -> Column:
    """A column by its literal name: hyphens, dots and reserved words included."""
    return F.col("`" + name.replace("`", "``") + "`")


def month_start(date: Column) -> Column:
    return F.trunc(date.cast("date"), "month")


def month_of(year: Column, month: Column) -> Column:
    """First of the month; NULL where year or month is missing or out of range."""
    y, m = year.cast("int"), month.cast("int")
    return F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def months_between(start: Column, end: Column) -> Column:
    """Month boundaries crossed from ``start`` to ``end``."""
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("long")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed; read off the clock fields, so no time zone is involved."""
    def clock(t: Column) -> Column:
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)

    days = F.datediff(end.cast("date"), start.cast("date")).cast("long")
    return days * 86400 + (clock(end) - clock(start))


def days_in_month(date: Column) -> Column:
    return F.dayofmonth(F.last_day(date))


def without_sentinels(column: Column, sentinels: Iterable[float] = SENTINELS) -> Column:
    return F.when(~column.isin(*sentinels), column)


def clean_curves(df: DataFrame, columns: list[str],
                 sentinels: Iterable[float] = SENTINELS) -> DataFrame:
    """Replace the placeholders by NULL in the listed columns."""
    listed = set(columns)
    return df.select([
        without_sentinels(quoted(c), sentinels).alias(c) if c in listed else quoted(c)
        for c in df.columns
    ])


def file_slug(name: Column) -> Column:
    return F.translate(name, "/ ", "-_")


def two_way_bucket(column: Column, value: str, hit: str, other: str = "Other") -> Column:
    """``hit`` where the column equals ``value``; ``other`` for the rest and for NULL."""
    return F.when(column == value, hit).otherwise(other)


def rescale(value: Column, from_lo: float, from_hi: float, to_lo: float, to_hi: float) -> Column:
    """Map ``[from_lo, from_hi]`` linearly onto ``[to_lo, to_hi]``; either may run downwards."""
    return F.lit(to_lo) + (value - F.lit(from_lo)) / F.lit(from_hi - from_lo) * F.lit(to_hi - to_lo)


def rounded(value: Column, decimals: int | None) -> Column:
    return value if decimals is None else F.round(value, decimals)
