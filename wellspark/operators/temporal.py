"""Run collapsing, change detection and calendar filling.

Input rows are unique per ``(keys, time)``; :func:`dedupe_key` makes them so. NULL is a value:
a run of NULLs is a run, and a step to or from NULL is a change. The first row of an entity
always counts, and nothing is smoothed.

Windows work inside slices of an entity's time (see ``slices``); the first and last rows of the
slices meet in a second, small window. ``every`` is the width of a slice in days for dates, in
seconds for timestamps, in ones for numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.functions.columns import months_between, quoted
from wellspark.operators.slices import SLICE, slice_of


def _cols(names: list[str]) -> list[Column]:
    return [quoted(n) for n in names]


def dedupe_key(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key; of conflicting values the smallest non-NULL one of each column is kept."""
    return df.groupBy(*_cols(keys)).agg(*[F.min(quoted(v)).alias(v) for v in values])


def dedupe_rows(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key, whole: the smallest by its values in order, NULL after every value."""
    order = F.struct(*[c for v in values for c in (quoted(v).isNull().alias(f"_null_{v}"), quoted(v))])
    return df.groupBy(*_cols(keys)).agg(F.min(order).alias("_row")).select(
        *_cols(keys), *[F.col("_row").getField(v).alias(v) for v in values])


def _sliced(df: DataFrame, time: str, every: int | None) -> DataFrame:
    return df.withColumn(SLICE, slice_of(quoted(time), dict(df.dtypes)[time], every))


def _local_changes(df: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """Flag, inside each slice, the rows that differ from the row before (the first one too)."""
    w = Window.partitionBy(*_cols(keys), SLICE).orderBy(quoted(time))
    state = F.struct(*_cols(values))
    return df.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_change", (F.col("_rn") == 1) | ~state.eqNullSafe(F.lag(state).over(w)))


def _close_runs(rows: DataFrame, keys: list[str], start: str, end: str,
                opens: Column) -> DataFrame:
    """Merge each row that opens a run with the rows up to the next one that does.

    ``rows`` span ``[start, end]`` in time order. Adds ``valid_to`` and ``_at_end`` (no later run
    of the same keys). Works by looking one row ahead, so no aggregation and no wide frame.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(quoted(start))
    edges = (
        rows.withColumn("_opens", opens)
        .withColumn("_is_last", F.lead(F.lit(True)).over(w).isNull())
        .withColumn("_before", F.lag(quoted(end)).over(w))
        .where(F.col("_opens") | F.col("_is_last"))
        # What this row says about the end of the run before it.
        .withColumn("_tells", F.when(F.col("_opens"), F.col("_before")).otherwise(quoted(end)))
    )
    return (
        edges.withColumn("_valid_to", F.when(F.col("_is_last"), quoted(end))
                         .otherwise(F.lead("_tells").over(w)))
        .withColumn("_at_end", F.col("_is_last") | ~F.lead("_opens").over(w))
        .where("_opens")
        .drop("_opens", "_is_last", "_before", "_tells")
    )


def collapse_intervals(df: DataFrame, keys: list[str], time: str, value: str,
                       carry: tuple[str, ...] = (), every: int | None = None) -> DataFrame:
    """One row per run of equal values: keys, value, carried columns, valid_from, valid_to.

    Both ends of the interval are observed times. ``carry`` columns take the value they had on
    the first row of the run.
    """
    rows = df.select(*_cols(keys), quoted(value), *_cols(list(carry)), quoted(time))
    flagged = _local_changes(_sliced(rows, time, every), keys, time, [value])
    runs = _close_runs(flagged, [*keys, SLICE], time, time, F.col("_change")).select(
        *_cols(keys), quoted(value), *_cols(list(carry)), quoted(time).alias("valid_from"),
        F.col("_valid_to").alias("valid_to"), (F.col("_rn") == 1).alias("_at_start"), "_at_end", SLICE)
    # At most two runs of a slice reach its edges; only these can continue a neighbour's run, and
    # they meet per entity. The others are dealt out by their slice and stay what they are.
    runs = _by_edge(runs, F.col("_at_start") | F.col("_at_end"))
    over = Window.partitionBy(*_cols(keys), *_EDGE).orderBy("valid_from")
    runs = runs.withColumn("_continues", F.coalesce(
        F.col("_at_start") & F.lag("_at_end").over(over)
        & quoted(value).eqNullSafe(F.lag(quoted(value)).over(over)), F.lit(False))).drop("_at_end")
    merged = _close_runs(runs, [*keys, *_EDGE], "valid_from", "valid_to", ~F.col("_continues"))
    return merged.drop("valid_to").withColumnRenamed("_valid_to", "valid_to").select(
        *_cols(keys), quoted(value), *_cols(list(carry)), "valid_from", "valid_to")


_EDGE = ["_edge", "_inside"]


def _by_edge(rows: DataFrame, edge: Column) -> DataFrame:
    """Marks that keep the edges of all slices of an entity together, and the other rows by slice."""
    return rows.withColumn("_edge", edge).withColumn("_inside", F.when(~F.col("_edge"), F.col(SLICE)))


def detect_transitions(df: DataFrame, keys: list[str], time: str, values: list[str],
                       every: int | None = None) -> DataFrame:
    """Rows where any of the values changed since the entity's row before; first rows too."""
    out = [*_cols(keys), quoted(time), *_cols(values)]
    within = Window.partitionBy(*_cols(keys), SLICE).orderBy(quoted(time))
    flagged = _local_changes(_sliced(df.select(*out), time, every), keys, time, values).withColumn(
        "_is_last", F.lead(F.lit(True)).over(within).isNull())
    # What changes inside a slice is known; its first row is compared with the last one of the
    # slice before, so these two meet per entity.
    first = F.col("_rn") == 1
    rows = _by_edge(flagged.where(F.col("_change") | F.col("_is_last")), first | F.col("_is_last"))
    over = Window.partitionBy(*_cols(keys), *_EDGE).orderBy(quoted(time))
    state = F.struct(*_cols(values))
    return (
        rows.withColumn("_first", F.row_number().over(over) == 1)
        .withColumn("_differs", ~state.eqNullSafe(F.lag(state).over(over)))
        .where(F.when(first, F.col("_first") | F.col("_differs")).otherwise(F.col("_change")))
        .select(*out)
    )


def previous(df: DataFrame, keys: list[str], time: str, name: str = "previous",
             every: int | None = None) -> DataFrame:
    """Add the entity's previous time (NULL on its first row)."""
    within = Window.partitionBy(*_cols(keys), SLICE).orderBy(quoted(time))
    over = Window.partitionBy(*_cols(keys)).orderBy(quoted(time))
    stepped = (
        _sliced(df, time, every).withColumn("_rn", F.row_number().over(within))
        .withColumn(name, F.lag(quoted(time)).over(within))
        .withColumn("_is_last", F.lead(F.lit(True)).over(within).isNull())
    )
    out = [*_cols(df.columns), quoted(name)]
    inner = stepped.where(F.col("_rn") > 1).select(*out)
    # The row before a slice's first row is the last one of the slice before.
    edges = (
        stepped.where((F.col("_rn") == 1) | F.col("_is_last"))
        .withColumn(name, F.lag(quoted(time)).over(over))
        .where(F.col("_rn") == 1)
    )
    return inner.unionByName(edges.select(*out))


def fill_calendar(df: DataFrame, keys: list[str], date: str, values: list[str]) -> DataFrame:
    """A row for every month from an entity's first to its last; absent months hold NULLs.

    Dates are firsts of months. Each row emits itself and the missing months up to the next
    row, so there is no month grid to join back to.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(quoted(date))
    until = F.greatest(
        F.coalesce(F.add_months(F.lead(quoted(date)).over(w), -1), quoted(date)), quoted(date))
    return (
        df.withColumn("_until", until)
        .select(*_cols(keys), *_cols(values), F.posexplode(
            F.sequence(quoted(date), F.col("_until"), F.expr("interval 1 month"))
        ).alias("_step", date))
        .select(*_cols(keys), quoted(date), *[
            F.when(F.col("_step") == 0, quoted(v)).alias(v) for v in values])
    )


def gap_audit(df: DataFrame, key: str, date: str) -> DataFrame:
    """Per entity: first and last month, months expected and observed, gaps, longest gap."""
    months = df.where(quoted(date).isNotNull()).select(quoted(key), quoted(date)).distinct()
    w = Window.partitionBy(quoted(key)).orderBy(quoted(date))
    step = months_between(F.lag(quoted(date)).over(w), quoted(date))
    expected = months_between(F.col("first_month"), F.col("last_month")) + 1
    return (
        months.withColumn("_step", step)
        .groupBy(quoted(key))
        .agg(F.min(quoted(date)).alias("first_month"), F.max(quoted(date)).alias("last_month"),
             F.count(F.lit(1)).alias("observed_months"),
             F.coalesce(F.max("_step") - 1, F.lit(0)).alias("longest_gap_months"))
        .select(quoted(key), "first_month", "last_month", expected.alias("expected_months"),
                "observed_months", (expected - F.col("observed_months")).alias("gap_count"),
                "longest_gap_months")
    )


def gap_headline(gaps: DataFrame) -> DataFrame:
    """One row over a gap audit: entities, entities with gaps, largest counts."""
    return gaps.agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("gap_count") > 0).alias("entities_with_gaps"),
        F.max("gap_count").alias("max_gap_count"),
        F.max("longest_gap_months").alias("max_longest_gap"))
