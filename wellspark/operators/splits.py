"""Cross-validation splits that keep a whole entity on one side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted


def assign_fold(df: DataFrame, key: str, folds: int, held_out: int = 0) -> DataFrame:
    """Add ``fold`` (key modulo the number of folds) and ``role`` (test or train).

    Rows without a key belong to no fold and always train: there is no entity to leak.
    """
    fold = F.pmod(quoted(key), F.lit(folds)).cast("int")
    return df.withColumn("fold", fold).withColumn(
        "role", F.when(F.col("fold") == held_out, "test").otherwise("train"))


def leave_one_out(df: DataFrame, key: str, held_out) -> tuple[DataFrame, DataFrame]:
    """Training rows (every other entity) and test rows (the held-out entity)."""
    is_held = quoted(key).eqNullSafe(F.lit(held_out))
    return df.where(~is_held), df.where(is_held)
