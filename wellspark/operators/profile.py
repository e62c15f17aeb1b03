"""Profiling and reconciliation of tables."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.functions.columns import quoted
from wellspark.operators.quantiles import exact_quantiles
from wellspark.operators.slices import dealt_by


def _rows(structs: list[Column]) -> Column:
    """Turn a list of structs computed on one row into rows."""
    return F.inline(F.array(*structs))


def volatility(df: DataFrame, key: str, buckets: dict[str, str]) -> DataFrame:
    """Per column: entities whose non-NULL value ever changed, and their share.

    ``buckets`` maps candidate columns to the bucket expected for them; columns the table lacks
    are skipped. A column changed where the smallest and largest 64-bit hash of its values differ:
    two numbers per column are all an entity needs, so tasks reduce their rows in a hash table
    before the shuffle, without sorting them.
    """
    columns = [c for c in buckets if c in df.columns]
    if not columns:
        raise ValueError("none of the candidate columns is in the table")
    hashes = {c: F.when(quoted(c).isNotNull(), F.xxhash64(quoted(c))) for c in columns}
    per_entity = df.groupBy(quoted(key)).agg(
        *[F.min(h).alias(f"_lo_{c}") for c, h in hashes.items()],
        *[F.max(h).alias(f"_hi_{c}") for c, h in hashes.items()])
    counted = per_entity.agg(F.count(F.lit(1)).alias("_total"), *[
        F.count_if(quoted(f"_lo_{c}") < quoted(f"_hi_{c}")).alias(f"_changed_{c}")
        for c in columns
    ], *[F.count(quoted(f"_lo_{c}")).alias(f"_valued_{c}") for c in columns])

    def row(c: str) -> Column:
        changed, valued = quoted(f"_changed_{c}"), quoted(f"_valued_{c}")
        share = F.round(changed.cast("double") * 100.0 / F.nullif(valued, F.lit(0)), 3)
        return F.struct(
            F.lit(c).alias("column_name"), F.lit(buckets[c]).alias("expected_bucket"),
            changed.alias("entities_with_change"), valued.alias("entities_with_value"),
            F.col("_total").alias("total_entities"), share.alias("pct_changed"))

    return counted.select(_rows([row(c) for c in columns]))


def coverage(sources: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows and distinct keys of each source, and the keys shared by each pair.

    Every source is counted per key first, so the sources meet in one grouping and no join runs.
    """
    names = list(sources)
    per_source = [
        df.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_source", F.lit(name))
        for name, df in sources.items()
    ]
    per_key = reduce(DataFrame.unionByName, per_source).groupBy(quoted(key)).agg(*[
        F.sum(F.when(F.col("_source") == n, F.col("_rows"))).alias(f"_n_{n}") for n in names])
    has_key = quoted(key).isNotNull()

    def present(*which: str) -> Column:
        return reduce(lambda a, b: a & b, [quoted(f"_n_{n}").isNotNull() for n in which], has_key)

    singles = [(n, F.coalesce(F.sum(quoted(f"_n_{n}")), F.lit(0)), F.count_if(present(n)))
               for n in names]
    pairs = [(f"{a}_AND_{b}", F.max(F.lit(None).cast("long")), F.count_if(present(a, b)))
             for a, b in combinations(names, 2)]
    both = singles + pairs
    one = per_key.agg(*[rows.alias(f"_r{i}") for i, (_, rows, _) in enumerate(both)],
                      *[keys.alias(f"_k{i}") for i, (_, _, keys) in enumerate(both)])
    return one.select(_rows([
        F.struct(F.lit(name).alias("source"), F.col(f"_r{i}").alias("row_count"),
                 F.col(f"_k{i}").alias("distinct_keys"))
        for i, (name, _, _) in enumerate(both)
    ]))


def field_agreement(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per shared column: pairs of rows with the same key that agree, disagree, and exist.

    NULL agrees with NULL, and values of different types as far as Spark's common type of both
    makes them equal (1 and 1.0, a day and its midnight, both zeros). Equal cells, as 64-bit
    hashes, are counted per key and side, and the pairs follow from the counts, so repeated keys
    do not multiply rows. Rows of hashes are dealt out by key once, to tasks of a bounded number
    of rows that count them.
    """
    shared = sorted((set(left.columns) & set(right.columns)) - {key})
    common = left.select(*[quoted(c) for c in shared]).limit(0).union(right.select(*[quoted(c) for c in shared]).limit(0))

    def cell(field: T.StructField) -> Column:
        value = quoted(field.name).cast(field.dataType)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)
        return F.xxhash64(value, value.isNull()).alias(field.name)

    def hashed(df: DataFrame, in_left: int) -> DataFrame:
        return df.where(quoted(key).isNotNull()).select(
            quoted(key), *[cell(f) for f in common.schema], F.lit(in_left).cast("long").alias("_l"),
            F.lit(1 - in_left).cast("long").alias("_r"))

    # Exploding, unlike unpivot, leaves the rows known as dealt out by key.
    matched = (
        dealt_by(hashed(left, 1).unionByName(hashed(right, 0)), quoted(key))
        .select(quoted(key), "_l", "_r", _rows([
            F.struct(F.lit(c).alias("column_name"), quoted(c).alias("_value")) for c in shared]))
        .groupBy(quoted(key), "column_name", "_value")
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .groupBy(quoted(key), "column_name")
        .agg(F.sum(F.col("_l") * F.col("_r")).alias("_agree"),
             (F.sum("_l") * F.sum("_r")).alias("_pairs"))
    )
    return matched.groupBy("column_name").agg(
        F.sum("_agree").alias("agreement_count"),
        (F.sum("_pairs") - F.sum("_agree")).alias("disagreement_count"),
        F.sum("_pairs").alias("overlap_count"))


def keys_only_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` that ``other`` does not have."""
    return df.select(quoted(key)).distinct().join(
        other.select(quoted(key)).distinct(), key, "left_anti")


def rows_only_in(df: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Key and label columns of the rows of ``df`` whose key ``other`` does not have."""
    return df.select(quoted(key), *[quoted(c) for c in columns]).join(
        other.select(quoted(key)).distinct(), key, "left_anti")


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, NULL included."""
    return df.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias(name))


def distinct_per_entity(df: DataFrame, key: str, column: str, name: str = "n_values") -> DataFrame:
    """Per entity that has any: the number of distinct non-NULL values."""
    pairs = df.where(quoted(column).isNotNull()).select(quoted(key), quoted(column)).distinct()
    return pairs.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias(name))


def histogram(df: DataFrame, metric: str, bins: int | None = None, most: int = 20) -> DataFrame:
    """Equal-width histogram between the smallest and largest value, empty bins included.

    Without ``bins`` their number is the largest value, kept between 1 and ``most``. The largest
    value belongs to the last bin; when all values are equal the range is widened by a half on
    both sides.
    """
    values = df.where(quoted(metric).isNotNull()).select(
        quoted(metric).cast("double").alias("_v"))
    number = F.lit(bins) if bins else F.least(
        F.greatest(F.floor(F.max("_v")).cast("int"), F.lit(1)), F.lit(most))
    flat = F.min("_v") == F.max("_v")
    shape = values.agg(
        F.when(flat, F.min("_v") - 0.5).otherwise(F.min("_v")).alias("_lo"),
        F.when(flat, F.max("_v") + 0.5).otherwise(F.max("_v")).alias("_hi"),
        number.cast("int").alias("_bins"))
    lo, hi, n = (shape.select(c).scalar() for c in ("_lo", "_hi", "_bins"))
    filled = (
        values.groupBy(F.least(
            F.floor((F.col("_v") - lo) / (hi - lo) * n).cast("int"), n - 1).alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    width = (F.col("_hi") - F.col("_lo")) / F.col("_bins")
    edges = shape.where(F.col("_lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)).alias("bin"),
        F.col("_lo").alias("_from"), width.alias("_width"))
    # One row per bin on both sides.
    return edges.join(filled, "bin", "left").select(
        "bin", (F.col("_from") + F.col("bin") * F.col("_width")).alias("bin_from"),
        (F.col("_from") + (F.col("bin") + 1) * F.col("_width")).alias("bin_to"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n"))


def missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: present and missing cells and the missing share in percent. One pass."""
    columns = columns or df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(quoted(c)).alias(f"_c_{c}") for c in columns])

    def row(c: str) -> Column:
        present = quoted(f"_c_{c}")
        gone = F.col("_rows") - present
        return F.struct(
            F.lit(c).alias("column_name"), present.alias("n_present"), gone.alias("n_missing"),
            F.round(gone.cast("double") * 100.0 / F.nullif(F.col("_rows"), F.lit(0)), 2)
            .alias("pct_missing"))

    return one.select(_rows([row(c) for c in columns]))


def time_ranges(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per date or time column: its first and last day. One pass."""
    columns = columns or [f.name for f in df.schema
                          if isinstance(f.dataType, (T.DateType, T.TimestampType,
                                                     T.TimestampNTZType))]
    one = df.agg(*[F.min(quoted(c)).cast("date").alias(f"_lo_{c}") for c in columns],
                 *[F.max(quoted(c)).cast("date").alias(f"_hi_{c}") for c in columns])
    return one.select(_rows([
        F.struct(F.lit(c).alias("column_name"), quoted(f"_lo_{c}").alias("first_day"),
                 quoted(f"_hi_{c}").alias("last_day")) for c in columns]))


def numeric_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, standard deviation, extremes and exact quartiles.

    NULL and NaN are left out of all of them.
    """
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    numbers = df.select(*[F.nullif(quoted(c).cast("double"), F.lit(float("nan"))).alias(c) for c in columns])
    one = numbers.agg(*[
        F.struct(F.count(quoted(c)).alias("n"), F.avg(quoted(c)).alias("mean"),
                 F.stddev_samp(quoted(c)).alias("std"), F.min(quoted(c)).alias("min"),
                 F.max(quoted(c)).alias("max")).alias(c) for c in columns])
    basic = one.select(_rows([
        F.struct(F.lit(c).alias("column_name"),
                 *[quoted(c).getField(f).alias(f) for f in ("n", "mean", "std", "min", "max")])
        for c in columns]))
    long = numbers.unpivot([], columns, "column_name", "_value")
    quartiles = exact_quantiles(long, ["column_name"], "_value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    # One row per column of the table on both sides.
    return basic.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def corpus_stats(df: DataFrame, entity: str, label: str, split: str,
                 file: str | None = None) -> DataFrame:
    """Rows, entities, files, and rows per label and per split, as ``(metric, item, n)``.

    The table is read once into counts per combination; everything else follows from those.
    """
    by = [entity, label, split] + ([file] if file else [])
    counts = df.groupBy(*[quoted(c) for c in by]).agg(F.count(F.lit(1)).alias("_n"))

    def total(metric: str, frame: DataFrame, item: Column, n: Column) -> DataFrame:
        return frame.groupBy(item.cast("string").alias("item")).agg(n.alias("n")).select(
            F.lit(metric).alias("metric"), "item", "n")

    def distinct(metric: str, column: str) -> DataFrame:
        values = counts.select(quoted(column)).where(quoted(column).isNotNull()).distinct()
        return total(metric, values, F.lit(None), F.count(F.lit(1)))

    parts = [total("rows", counts, F.lit(None), F.sum("_n")), distinct("entities", entity),
             total("label", counts, quoted(label), F.sum("_n")),
             total("split", counts, quoted(split), F.sum("_n"))]
    if file:
        parts.append(distinct("files", file))
    return reduce(DataFrame.unionByName, parts)
