"""Compare a Spark result with the result of the check SQL, cell by cell."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results are equal, else a short account of the first difference."""
    got_names, got = _table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names, want = _table([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != names:
        return f"columns {got_names} vs {names}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{dict(zip(names, a))} vs {dict(zip(names, b))}"
    return None
