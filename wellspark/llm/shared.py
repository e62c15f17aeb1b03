"""Helpers of the text operators: tables in the shared folder, Bloom filters, folds, batches."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.session import shared_folder
from wellspark.sources.files import discard

SLICES = 64  # a filter is made of so many slices, each filled by one task
FOLDS = 5


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Tables shared inside the block go when it ends, with or without an error.

    What is returned from the block must not read them any more: ``shared_table`` with
    ``stays`` writes a result that does not go.
    """
    folder = shared_folder(spark)
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        discard(spark, folder)


def shared_table(df: DataFrame, stays: bool = False) -> DataFrame:
    """``df`` written to the folder all machines share, and read again: its lineage ends there."""
    path, inside = shared_folder(df.sparkSession), _scratch.get()
    if inside and not stays:
        path = f"{inside}/{path.rsplit('/', 1)[1]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS


def fraction(seed: str, *columns: str) -> Column:
    """A number in [0, 1) that depends on nothing but the seed and the row's own values."""
    h = F.xxhash64(F.lit(seed), *columns)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def only(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that further columns of ``docs`` cannot clash with new ones."""
    return docs.select(*columns)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the murmur3 finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _probes(h: np.ndarray, slice_bits: int) -> tuple[np.ndarray, np.ndarray]:
    m = mix(h)
    bits = np.uint64(slice_bits)
    return (m % bits).astype(np.int64), ((m >> np.uint64(32)) * np.uint64(0x9E3779B1) % bits).astype(np.int64)


def twice_seen(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of hashes seen at least twice, ``bits`` long whatever the number of hashes.

    ``hashes`` has ``h`` (long) and ``twice`` (boolean: the sender has already seen it twice).
    Each slice of the hash space has two Bloom filters, once seen and twice seen: what the first
    one has already enters the second. Full filters only mean more suspects, never a missed one.
    """
    slice_bits = bits // SLICES

    def fill(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            sent_twice = batch.column(1).to_numpy(zero_copy_only=False)
            values, first, n = np.unique(h, return_index=True, return_counts=True)
            again = (n > 1) | sent_twice[first]
            part = (values % np.uint64(SLICES)).astype(np.int64)
            for s in np.unique(part):
                here = part == s
                a, b = _probes(values[here], slice_bits)
                seen = once.setdefault(int(s), np.zeros(slice_bits, bool))
                repeat = again[here] | (seen[a] & seen[b])
                seen[a] = seen[b] = True
                more = twice.setdefault(int(s), np.zeros(slice_bits, bool))
                more[a[repeat]] = more[b[repeat]] = True
        for s, found in twice.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(found).tobytes()], pa.binary())],
                ["slice", "bits"])

    dealt = (hashes.select("h", "twice", F.pmod("h", F.lit(SLICES)).alias("slice"))
             .repartition(partitions(hashes.sparkSession), "slice").select("h", "twice"))
    table = np.zeros((SLICES, slice_bits // 8), np.uint8)
    # A slice's filter is the same size for any input, so at most `bits` bits reach the driver.
    for row in dealt.mapInArrow(fill, "slice int, bits binary").collect():
        table[row["slice"]] |= np.frombuffer(row["bits"], np.uint8)
    return table


def in_filter(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    part = (h % np.uint64(SLICES)).astype(np.int64)
    hit = np.ones(len(h), bool)
    for p in _probes(h, table.shape[1] * 8):
        hit &= (table[part, p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1
    return hit
