"""Sums of a fact table over attributes of its dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted


def sums_by_dimension(fact: DataFrame, dimension: DataFrame, key: str, measures: list[str],
                      by_fact: list[str] | None = None,
                      by_dimension: list[str] | None = None) -> DataFrame:
    """Inner join and grouped sums.

    The facts are summed per key before they meet the dimension, which turns a hot key into a few
    rows; how the join is done is left to Spark.
    """
    on_fact = [quoted(c) for c in by_fact or []]
    on_dimension = [quoted(c) for c in by_dimension or []]
    sums = [F.sum(quoted(m)).alias(m) for m in measures]
    per_key = fact.groupBy(quoted(key), *on_fact).agg(*sums)
    joined = per_key.join(dimension.select(quoted(key), *on_dimension), key)
    return joined.groupBy(*on_fact, *on_dimension).agg(*sums)


def top(df: DataFrame, n: int, by: Column, *ties: str) -> DataFrame:
    """The first ``n`` rows by a descending value; ties fall to the smaller key."""
    return df.orderBy(by.desc_nulls_last(), *[quoted(t) for t in ties]).limit(n)
