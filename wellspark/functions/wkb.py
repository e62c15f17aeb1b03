"""Structure check of a well-known-binary geometry column."""

from __future__ import annotations

import struct
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get the check by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the format: geometry type codes and the bits that extend them.
POINT, LINE, POLYGON, COLLECTIONS = 1, 2, 3, (4, 5, 6, 7)
Z_FLAG, M_FLAG, SRID_FLAG = 0x80000000, 0x40000000, 0x20000000


def _end_of_geometry(data: bytes, at: int) -> int:
    """Offset just past the geometry that starts at ``at``; raises when it does not fit."""
    order = {0: ">", 1: "<"}[data[at]]
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 9 if code & SRID_FLAG else 5
    flat = code & 0x0FFFFFFF
    dims = 2 + bool(code & Z_FLAG) + bool(code & M_FLAG)
    if flat >= 1000:
        dims += (0, 1, 1, 2)[flat // 1000]
        flat %= 1000

    def count() -> int:
        return struct.unpack_from(order + "I", data, at)[0]

    if flat == POINT:
        at += 8 * dims
    elif flat == LINE:
        at += 4 + 8 * dims * count()
    elif flat == POLYGON:
        rings, at = count(), at + 4
        for _ in range(rings):
            at += 4 + 8 * dims * count()
    elif flat in COLLECTIONS:
        members, at = count(), at + 4
        for _ in range(members):
            at = _end_of_geometry(data, at)
    else:
        raise ValueError("unknown geometry type")
    if at > len(data):
        raise ValueError("truncated")
    return at


def _is_valid(data: bytes | None) -> bool | None:
    if data is None:
        return None
    try:
        return _end_of_geometry(data, 0) == len(data)
    except (KeyError, IndexError, ValueError, struct.error, RecursionError):
        return False


@F.pandas_udf(T.BooleanType())
def _wkb_valid(values: pd.Series) -> pd.Series:
    return values.map(_is_valid).astype("object")


def _number(data: Column, at: Column, big: Column) -> Column:
    """The four bytes at an offset as a number; NULL where they are not all there."""
    digits = F.hex(F.substring(data, at + 1, F.lit(4)))
    turned = F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)])
    return F.when(F.length(data) >= at + 4, F.conv(F.when(big, digits).otherwise(turned), 16, 10).cast("long"))


def _simple(data: Column) -> tuple[Column, Column]:
    """Whether a geometry is a point, line or polygon, and whether its bytes are one whole one.

    A polygon's rings are gone through by their counts: each tells where the next one begins.
    """
    big = F.substring(data, 1, 1) == F.lit(bytearray(b"\0"))
    ordered = big | (F.substring(data, 1, 1) == F.lit(bytearray(b"\1")))
    code, size = _number(data, F.lit(1), big), F.length(data).cast("long")

    def flag(bit: int) -> Column:
        return (code.bitwiseAND(F.lit(bit)) != 0).cast("long")

    flat = code.bitwiseAND(F.lit(0x0FFFFFFF))
    level = F.floor(flat / 1000)
    kind = F.when(level <= 3, flat % 1000)
    width = 8 * (2 + flag(Z_FLAG) + flag(M_FLAG) + F.when(level == 0, 0).when(level == 3, 2).otherwise(1))
    head = 5 + 4 * flag(SRID_FLAG)
    count = _number(data, head.cast("int"), big)
    # A ring is four bytes at least, so no more of them are looked for than can be there.
    rings = F.sequence(F.lit(1).cast("long"), F.least(count, F.floor(size / 4) + 1))
    polygon = F.when(count == 0, head + 4).otherwise(F.aggregate(rings, head + 4, lambda at, _: F.when(
        at + 4 <= size, at + 4 + width * _number(data, at.cast("int"), big)).otherwise(F.lit(-1).cast("long"))))
    end = F.when(kind == POINT, head + width).when(kind == LINE, head + 4 + width * count).when(
        (kind == POLYGON) & (count <= size), polygon)
    simple = ordered & kind.isin(POINT, LINE, POLYGON)
    return F.coalesce(simple, F.lit(False)), F.coalesce(end == size, F.lit(False))


def wkb_valid(column: Column) -> Column:
    """True when the bytes are one whole geometry; NULL for NULL.

    Points, lines and polygons are measured by built-in functions; only collections, whose members
    are geometries of their own, are read through in Python.
    """
    simple, whole = _simple(column)
    return F.when(column.isNull(), F.lit(None).cast("boolean")).when(simple, whole).otherwise(
        _wkb_valid(F.when(~simple, column)))
