"""Which rows go to which file, from counts that are known before the rows are read.

Rows are counted per partition folder, entity and slice of time; or the counts are known already,
as those of instances are from their catalog. A running sum over the counts in file order deals
them out to tasks of a given number of rows, and the rows are sent there by the number of the
task. The input runs once, where a range partitioning would run it a second time for its sample.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted
from wellspark.operators.slices import STEPS, slice_of
from wellspark.session import shared_folder
from wellspark.sources.files import discard

# Small files are written many to a task: tasks become larger than a file where there would be more
# of them than this, up to so many rows.
MOST_TASKS, ROWS_PER_TASK = 240, 2_500_000
RANGE = 1000  # whole-numbered entities are counted in ranges of so many, unless a range is large
_WHOLE = ("bigint", "int", "smallint", "tinyint")


@dataclass
class Plan:
    """Tasks by range of entities, and by entity and slice inside ranges that are more than a task."""

    ranges: DataFrame
    cells: DataFrame | None
    tasks: int
    rows_per_task: int


def _at(df: DataFrame, time: str | None) -> Column:
    """A time as a number, to divide a slice by."""
    kind = dict(df.dtypes).get(time)
    if time is None or kind in ("string", "binary", "boolean"):
        return F.lit(0.0)
    column = quoted(time)
    if kind == "date":
        column = F.unix_date(column)
    elif kind.startswith("timestamp"):
        column = column.cast("timestamp").cast("double")
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def _slice(df: DataFrame, time: str | None) -> Column:
    kind = dict(df.dtypes).get(time)
    return slice_of(quoted(time), kind) if kind in STEPS or kind in _WHOLE else F.lit(0).cast("long")


def _range(df: DataFrame, entity: str) -> Column:
    column = quoted(entity)
    return F.floor(column / RANGE).cast("long") if dict(df.dtypes)[entity] in _WHOLE else column


def count_cells(df: DataFrame, partition: list[str], entity: str, time: str | None) -> DataFrame:
    """Rows per partition, entity and slice of time, with the first and last time; reads these columns only."""
    at = _at(df, time)
    return df.groupBy(*[quoted(c) for c in partition], quoted(entity).alias("_entity"), _range(df, entity).alias("_range"),
                      _slice(df, time).alias("_slice")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi"))


def cells_of_instances(instances: DataFrame, partition: list[str], entity: str, rows: str, first: str, last: str) -> DataFrame:
    """The same from a catalog that has the rows and the first and last time of each entity.

    Rows are taken to be evenly spaced in time; where they are not, files come out uneven, but
    every row still has its file.
    """
    kind = dict(instances.dtypes)[first]
    lo, hi = _at(instances, first), _at(instances, last)
    step = STEPS[kind]
    begin, end = slice_of(quoted(first), kind), slice_of(quoted(last), kind)
    part = F.greatest(lo, F.col("_slice") * step), F.least(hi, (F.col("_slice") + 1) * step - 1)
    share = (part[1] - part[0] + 1) / (hi - lo + 1)
    return (instances.withColumn("_slice", F.explode_outer(F.sequence(begin, end)))
            .select(*[quoted(c) for c in partition], quoted(entity).alias("_entity"), _range(instances, entity).alias("_range"), "_slice",
                    F.ceil(F.coalesce(quoted(rows) * share, quoted(rows))).cast("long").alias("_n"),
                    F.coalesce(part[0], lo).alias("_lo"), F.coalesce(part[1], hi).alias("_hi")))


def _matched(a: DataFrame, b: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Joined on ``columns``, where NULL is a value; ``b``'s copies of them go."""
    other = {c: f"_of_{i}" for i, c in enumerate(columns)}
    b = b.select(*[quoted(c).alias(other.get(c, c)) for c in b.columns])
    on = reduce(Column.__and__, [quoted(c).eqNullSafe(F.col(o)) for c, o in other.items()])
    return a.join(b, on, how).drop(*other.values())


@contextmanager
def planned(cells: DataFrame, partition: list[str], rows_per_task: int, tasks: int | None = None):
    """Deal cells out to tasks; the tables of the plan are in the shared folder until the block ends.

    A range of entities of at most ``rows_per_task`` rows goes to one task, and so does a cell of
    a larger range; a larger cell is divided by time. A task has less than twice as many rows,
    unless the rows of one slice of one entity crowd together. Where that would be more than
    ``MOST_TASKS``, a task has more rows, for the writer to cut into files. ``tasks`` asks for a
    number of tasks instead. Tables of numbers only: Spark broadcasts them where they are small.
    """
    spark = cells.sparkSession
    folder = shared_folder(spark)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    keys = [quoted(c) for c in partition]
    try:
        cells = written(cells, "counts")
        ranges = cells.groupBy(*keys, "_range").agg(F.sum("_n").alias("_n"))
        # A row per partition folder, so one task can add them up.
        folders = cells.groupBy(*keys).agg(F.sum("_n").alias("_rows"))
        ahead = Window.partitionBy(F.lit(0)).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
        folders = folders.select(*keys, F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_start"))
        inside = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        places = _matched(ranges.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))), folders, partition, "inner")
        places = written(places.select(*keys, "_range", "_n", (F.col("_start") + F.col("_before")).alias("_start")), "ranges")
        rows, most = places.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
        if tasks:
            rows_per_task = max(1, -(-rows // tasks))
        else:
            rows_per_task = max(rows_per_task, min(ROWS_PER_TASK, -(-rows // MOST_TASKS)))
        whole = places.where(F.col("_n") <= rows_per_task).select(
            *keys, "_range", F.floor(F.col("_start") / rows_per_task).cast("int").alias("_range_task"))
        fine = None
        if most > rows_per_task:
            large = places.where(F.col("_n") > rows_per_task).select(*keys, "_range", F.col("_start").alias("_range_start"))
            earlier = Window.partitionBy(*keys, "_range").orderBy("_entity", "_slice").rowsBetween(Window.unboundedPreceding, -1)
            start = F.col("_range_start") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
            fine = written(_matched(cells, large, [*partition, "_range"], "inner").select(
                *keys, "_entity", "_slice", start.alias("_cell_start"), F.col("_n").alias("_cell_n"), "_lo", "_hi"), "cells")
        yield Plan(whole, fine, max(1, -(-rows // rows_per_task)), rows_per_task)
    finally:
        discard(spark, folder)


def dealt(df: DataFrame, plan: Plan, partition: list[str], order: list[str]) -> DataFrame:
    """Rows in the tasks of the plan, sorted there by partition and ``order``; a row without a place goes to the first."""
    entity, time = order[0], order[1] if len(order) > 1 else None
    rows = df.select("*", quoted(entity).alias("_entity"), _range(df, entity).alias("_range"),
                     _slice(df, time).alias("_slice"), _at(df, time).alias("_at"))
    rows = _matched(rows, plan.ranges, [*partition, "_range"], "left")
    task = F.col("_range_task")
    if plan.cells is not None:
        rows = _matched(rows, plan.cells, [*partition, "_entity", "_slice"], "left")
        span, n = F.col("_hi") - F.col("_lo"), F.col("_cell_n")
        share = F.coalesce(F.when(span > 0, (F.col("_at") - F.col("_lo")) / span), F.lit(0.0))
        # A cell is divided only if it is more than a task; its last time stays inside.
        within = F.when(n > plan.rows_per_task, F.least(F.floor(share * n), n - 1)).otherwise(0)
        task = F.coalesce(task, F.floor((F.col("_cell_start") + within) / plan.rows_per_task).cast("int"))
    rows = rows.withColumn("_task", task).repartitionById(plan.tasks, "_task")
    return rows.sortWithinPartitions(*[quoted(c) for c in [*partition, *order]]).select(*[quoted(c) for c in df.columns])
