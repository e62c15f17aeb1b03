"""Parity of a published table with its source and catalog.

Each side is reduced to counts or fingerprints first; the sides then meet in one grouping by
key, in which NULL is a key like any other. Only differences come out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted
from wellspark.session import keep


class ParityError(Exception):
    """Published data differ from their source."""


def side_by_side(sides: dict[str, DataFrame], keys: list[str], values: list[str]) -> DataFrame:
    """One row per key with each side's values as ``<side>_<value>``; NULL where a side lacks it.

    Sides have one row per key.
    """
    labelled = [
        df.select(*[quoted(k) for k in keys], *[quoted(v) for v in values],
                  F.lit(side).alias("_side")) for side, df in sides.items()
    ]
    return reduce(DataFrame.unionByName, labelled).groupBy(*[quoted(k) for k in keys]).agg(*[
        F.max(F.when(F.col("_side") == side, quoted(v))).alias(f"{side}_{v}")
        for v in values for side in sides
    ])


def mismatches(sides: dict[str, DataFrame], keys: list[str], values: list[str]) -> DataFrame:
    """Keys for which the sides do not all have the same values."""
    names = list(sides)
    differs = reduce(lambda a, b: a | b, [
        ~quoted(f"{a}_{v}").eqNullSafe(quoted(f"{b}_{v}"))
        for v in values for a, b in zip(names, names[1:])
    ])
    return side_by_side(sides, keys, values).where(differs)


def row_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))


def compare_counts(sides: dict[str, DataFrame], keys: list[str],
                   counted: dict[str, str] | None = None) -> DataFrame:
    """Keys whose row counts differ. ``counted`` names the sides that already hold counts."""
    counted = counted or {}
    frames = {
        side: (df.groupBy(*[quoted(k) for k in keys]).agg(F.sum(quoted(counted[side])).alias("n"))
               if side in counted else row_counts(df, keys))
        for side, df in sides.items()
    }
    return mismatches(frames, keys, ["n"])


def compare_distribution(source: DataFrame, published: DataFrame, column: str) -> DataFrame:
    """Values (NULL too) that do not occur equally often on both sides.

    Both sides are value counts by then, and the null-safe key keeps this an equi-join.
    """
    a = source.groupBy(quoted(column).alias("_a")).agg(F.count(F.lit(1)).alias("source_n"))
    b = published.groupBy(quoted(column).alias("_b")).agg(F.count(F.lit(1)).alias("published_n"))
    return (
        a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "full")
        .where(~F.col("source_n").eqNullSafe(F.col("published_n")))
        .select(F.coalesce("_a", "_b").alias(column), "source_n", "published_n")
    )


_LANE = 0xFFFFF  # 20 bits: sums of a lane stay exact for 2**43 rows


def _fingerprint(column: Column, name: str) -> list[Column]:
    cell = F.when(column.isNotNull(), F.xxhash64(column))
    return [
        F.bit_xor(cell).alias(f"{name}|xor"),
        F.sum(cell.bitwiseAND(F.lit(_LANE).cast("long"))).alias(f"{name}|low"),
        F.sum(F.shiftrightunsigned(cell, 44)).alias(f"{name}|high"),
        F.min(column).alias(f"{name}|min"), F.max(column).alias(f"{name}|max"),
        F.count(column).alias(f"{name}|count"),
        F.count_if(column.isNull()).alias(f"{name}|nulls"),
    ]


_PARTS = ("xor", "low", "high", "min", "max", "count", "nulls")


def _row_per_column(wide: DataFrame, columns: list[str], by: list[str],
                    extremes: str = "string") -> DataFrame:
    return wide.select(*[quoted(b) for b in by], F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[
            quoted(f"{c}|{p}").cast(extremes if p in ("min", "max") else "long").alias(p)
            for p in _PARTS]) for c in columns])))


def _merge_fingerprints(rows: DataFrame, by: list[str]) -> DataFrame:
    """Fingerprints of larger groups out of those of smaller ones."""
    merge = {"xor": F.bit_xor, "min": F.min, "max": F.max}
    return rows.groupBy(*[quoted(b) for b in by], "column_name").agg(
        *[merge.get(p, F.sum)(p).alias(p) for p in _PARTS])


def column_fingerprints(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Per group and column: content fingerprint, extremes, cells and NULLs; one scan.

    XOR does not depend on the order of rows but cancels on pairs of equal edits; the two sums
    over the hashes do not.
    """
    wide = df.groupBy(*[quoted(b) for b in by]).agg(
        *[e for c in columns for e in _fingerprint(quoted(c), c)])
    return _row_per_column(wide, columns, by)


def compare_fingerprints(source: DataFrame, published: DataFrame, columns: list[str],
                         by: list[str] | None = None) -> DataFrame:
    """Columns whose content differs per group (globally when ``by`` is empty)."""
    by = by or []
    sides = {"source": column_fingerprints(source, columns, by),
             "published": column_fingerprints(published, columns, by)}
    return mismatches(sides, [*by, "column_name"], list(_PARTS))


def _row_hash(columns: list[str]) -> Column:
    # The hash passes over NULLs, so where they are is hashed too.
    return F.xxhash64(*[quoted(c) for c in columns], *[quoted(c).isNull() for c in columns])


_ROW = "whole row"


def _row_parts(columns: list[str]) -> list[Column]:
    cell = _row_hash(columns)
    return [F.bit_xor(cell).alias(f"{_ROW}|xor"),
            F.sum(cell.bitwiseAND(F.lit(_LANE).cast("long"))).alias(f"{_ROW}|low"),
            F.sum(F.shiftrightunsigned(cell, 44)).alias(f"{_ROW}|high")]


def row_fingerprint(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Per group, a fingerprint over whole rows: catches cells swapped between rows."""
    wide = df.groupBy(*[quoted(b) for b in by]).agg(
        *_row_parts(columns or df.columns), F.count(F.lit(1)).alias("n"))
    return wide.select(*[quoted(b) for b in by], *[
        quoted(f"{_ROW}|{p}").alias(p) for p in ("xor", "low", "high")], "n")


def compare_rows(source: DataFrame, published: DataFrame, by: list[str],
                 columns: list[str] | None = None) -> DataFrame:
    """Groups whose rows differ as a whole."""
    columns = columns or [c for c in source.columns if c in published.columns]
    return mismatches({"source": row_fingerprint(source, by, columns),
                       "published": row_fingerprint(published, by, columns)},
                      by, ["xor", "low", "high", "n"])


def time_spans(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    return df.groupBy(*[quoted(k) for k in keys]).agg(
        F.min(quoted(time)).alias("start_ts"), F.max(quoted(time)).alias("end_ts"))


def compare_spans(source: DataFrame, catalog: DataFrame, published: DataFrame, keys: list[str],
                  time: str = "timestamp") -> DataFrame:
    """Instances whose first or last time differs between source, catalog and published rows."""
    return mismatches({"source": time_spans(source, keys, time), "catalog": catalog,
                       "published": time_spans(published, keys, time)},
                      keys, ["start_ts", "end_ts"])


def well_counts(source: DataFrame, wells: DataFrame, pinned: int | None) -> DataFrame:
    """Distinct real wells in the source, rows of the master, and the pin, in one row."""
    found = source.where(F.col("well_kind") == "real").select("well_id").distinct()
    return found.agg(F.count("well_id").alias("source_wells")).select(
        "source_wells",
        wells.agg(F.count(F.lit(1))).scalar().alias("master_wells"),
        F.lit(pinned).cast("long").alias("pinned_wells"))


_GROUP = ["instance_id", "event_class", "well_kind", "well_id", "class", "state"]


def _summary(df: DataFrame, sensors: list[str], columns: list[str]) -> DataFrame:
    """Everything parity needs of one side, per instance, label and state, kept in a checkpoint.

    This is the only scan of the side; the checks work on the summary.
    """
    return keep(df.groupBy(*[quoted(g) for g in _GROUP]).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("start_ts"),
        F.max("timestamp").alias("end_ts"), *_row_parts(columns),
        *[e for c in sensors for e in _fingerprint(quoted(c), c)]))


def parity_report(source: DataFrame, catalog: DataFrame, wells: DataFrame, published: DataFrame,
                  sensors: list[str], pinned_wells: int | None = None) -> DataFrame:
    """Differences found by each check, one row per check.

    ``source`` and ``published`` are observations with provenance columns. Each is scanned once,
    right away; the report over the two summaries is lazy.
    """
    pair, cls = ["instance_id", "event_class"], ["event_class"]
    columns = sorted(set(source.columns) & set(published.columns))
    a, b = (_summary(side, sensors, columns) for side in (source, published))
    a_cells, b_cells = (_row_per_column(side, sensors, cls, "double") for side in (a, b))

    def total(df: DataFrame, keys: list[str], n: str = "n_rows") -> DataFrame:
        return df.groupBy(*[quoted(k) for k in keys]).agg(F.sum(n).alias("n"))

    def counts(keys: list[str], **more: DataFrame) -> DataFrame:
        return mismatches({"source": total(a, keys), "published": total(b, keys), **{
            side: total(df, keys) for side, df in more.items()}}, keys, ["n"])

    def content(by: list[str]) -> DataFrame:
        sides = {side: _merge_fingerprints(df, by)
                 for side, df in (("source", a_cells), ("published", b_cells))}
        return mismatches(sides, [*by, "column_name"], list(_PARTS))

    def rows(df: DataFrame) -> DataFrame:
        return df.groupBy(*cls).agg(F.bit_xor(f"`{_ROW}|xor`").alias("xor"),
                                    F.sum(f"`{_ROW}|low`").alias("low"),
                                    F.sum(f"`{_ROW}|high`").alias("high"),
                                    F.sum("n_rows").alias("n"))

    def spans(df: DataFrame) -> DataFrame:
        return df.groupBy(*pair).agg(F.min("start_ts").alias("start_ts"),
                                     F.max("end_ts").alias("end_ts"))

    counted = well_counts(a, wells, pinned_wells)
    pinned = F.coalesce(F.col("pinned_wells"), F.col("master_wells"))
    checks = {
        "rows per class": counts(cls, catalog=catalog),
        "rows per instance": counts(pair, catalog=catalog),
        "label distribution": counts(["class"]),
        "state distribution": counts(["state"]),
        "sensor content": content([]),
        "sensor content per class": content(cls),
        "time spans": mismatches(
            {"source": spans(a), "catalog": catalog, "published": spans(b)}, pair,
            ["start_ts", "end_ts"]),
        "real wells": counted.where(
            (F.col("source_wells") != F.col("master_wells"))
            | (F.col("master_wells") != pinned)),
        "instances per class": mismatches(
            {"source": row_counts(a.select(*pair).distinct(), cls),
             "catalog": row_counts(catalog, cls)}, cls, ["n"]),
        "whole rows per class": mismatches(
            {"source": rows(a), "published": rows(b)}, cls, ["xor", "low", "high", "n"]),
    }
    return reduce(DataFrame.unionByName, [
        frame.agg(F.count(F.lit(1)).alias("differences")).select(
            F.lit(name).alias("check"), "differences") for name, frame in checks.items()
    ])


def enforce_parity(report: DataFrame) -> None:
    """Run all checks in one job and raise when any found a difference."""
    found = {r["check"]: r["differences"] for r in report.collect() if r["differences"]}
    if found:
        raise ParityError(", ".join(f"{name}: {n}" for name, n in found.items()))
