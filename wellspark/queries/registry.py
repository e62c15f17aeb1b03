"""Registration of queries and of the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wellspark.queries.bindings import with_bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register a function ``(spark, folder) -> DataFrame``; ``uses`` names the bindings in ``sql``."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_bindings(sql, uses)
        return fn
    return register
