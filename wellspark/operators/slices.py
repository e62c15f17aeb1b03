"""Time slices: pieces of an entity's rows that are a function of the time alone.

Rows are dealt out by entity and slice, so no task holds more of one entity than a slice has, and
a wrong clock value is a slice of its own. What crosses the edge of a slice is put together from
the first and last rows of the slices. This is done at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "_slice"
# Width of a slice by type of time: ten years of days or months, a day of seconds, numbers.
STEPS = {"date": 3653, "timestamp": 86_400, "timestamp_ntz": 86_400, "number": 100_000}
ROWS_PER_TASK = 100_000
_NUMBERS = ("bigint", "int", "smallint", "tinyint")


def slice_of(time: Column, dtype: str, every: int | None = None) -> Column:
    """The number of the slice that a time is in; ``every``: its width in days, seconds or ones."""
    if dtype == "date":
        at = F.unix_date(time)
    elif dtype == "timestamp":
        at = F.unix_seconds(time)
    elif dtype == "timestamp_ntz":
        day = F.unix_date(time.cast("date")).cast("long")
        at = (day * 24 + F.hour(time)) * 3600 + F.minute(time) * 60 + F.second(time)
    elif dtype in _NUMBERS:
        at = time
    else:
        raise TypeError(f"cannot slice along a column of type {dtype}")
    width = every or STEPS.get(dtype, STEPS["number"])
    return F.floor(at.cast("long") / F.lit(width)).cast("long")


def dealt_by(df: DataFrame, *keys: Column) -> DataFrame:
    """Rows dealt out by keys to as many tasks as the number of rows asks for.

    What a task then keeps per key stays the same as the table grows. The rows are counted before.
    """
    return df.repartition(max(1, -(-df.count() // ROWS_PER_TASK)), *keys)
