"""Registered queries: each operator on the given tables, with the SQL it must agree with."""

from wellspark.queries import field, files, gates, logs, production, profiling, sensors, temporal
from wellspark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "field", "files", "gates", "logs", "production", "profiling",
           "sensors", "temporal"]
