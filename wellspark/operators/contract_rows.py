"""A declared contract against every cell of a table, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.functions.columns import quoted

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BROKEN = (T.FloatType, T.DoubleType, T.DecimalType)


def _unfit(column: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """Whether a value that is there is not of the declared type; None where that cannot be."""
    if have == want:
        return None
    fits = column.try_cast(want)
    bad = column.isNotNull() & fits.isNull()
    if isinstance(have, _BROKEN) and isinstance(want, _WHOLE):  # a cast would cut the fraction off
        bad = bad | (column.isNotNull() & ~fits.cast(have).eqNullSafe(column))
    return bad


def contract_violations(df: DataFrame, contract: T.StructType, key: list[str] | None = None) -> DataFrame:
    """column_name, problem, violations: every check that the contract asks for, also those that hold.

    Problems: ``missing`` (a declared column that is not there: every row), ``unexpected`` (a column
    that is not declared: every row), ``not <type>`` (cells that are no value of the declared type),
    ``null`` (NULLs in a required column) and ``repeated key`` (rows that share their key, NULL
    being a value). All are sums of one aggregate: with a key, its groups carry the sums of their
    rows along, so the table is read and dealt out once.
    """
    have = {f.name: f.dataType for f in df.schema}
    checks: list[tuple[str, str, Column]] = []
    for field in contract:
        if field.name not in have:
            checks.append((field.name, "missing", F.lit(True)))
            continue
        column = quoted(field.name)
        unfit = _unfit(column, have[field.name], field.dataType)
        if unfit is not None:
            checks.append((field.name, f"not {field.dataType.simpleString()}", unfit))
        if not field.nullable:
            checks.append((field.name, "null", column.isNull()))
    checks += [(n, "unexpected", F.lit(True)) for n in have if n not in contract.names]
    sums = [F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(checks)]
    names = [(c, p) for c, p, _ in checks]
    if key:
        groups = df.groupBy(*[quoted(k) for k in key]).agg(*sums, F.count(F.lit(1)).alias("_rows"))
        totals = [F.sum(f"_{i}").alias(f"_{i}") for i in range(len(checks))]
        one = groups.agg(*totals, F.sum(F.when(F.col("_rows") > 1, F.col("_rows")).otherwise(0)).alias(f"_{len(checks)}"))
        names.append((", ".join(key), "repeated key"))
    else:
        one = df.agg(*sums)
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, problem string, violations bigint")
    report = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("problem"),
                                F.coalesce(f"_{i}", F.lit(0)).alias("violations")) for i, (c, p) in enumerate(names)])
    return one.select(F.explode(report).alias("r")).select("r.*")
