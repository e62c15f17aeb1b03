"""Document fingerprints of closed syncmers."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.llm.shared import mix, partitions

K = 32  # characters of an anchor
S = 8  # characters of the inner substrings of which the smallest is sought
BUCKETS_PER_TASK = 4
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 20  # characters whose hashes are in memory at a time


def _rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` characters in a row."""
    h = np.zeros(len(codes) - size + 1, np.uint64)
    for i in range(size):
        h = h * _BASE + codes[i:i + len(h)]
    return mix(h)


def _doubled(codes: np.ndarray) -> np.ndarray:
    """Hashes of K characters (a power of two), each from the hashes of its halves."""
    h, size = mix(codes + np.uint64(1)), 1
    while size < K:
        h = mix(h[:-size] * _BASE + h[size:])
        size *= 2
    return h


def _syncmers(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 64-bit hashes of the closed syncmers."""
    positions, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lo in range(0, len(text) - K + 1, _CHUNK):
        codes = np.frombuffer(text[lo:lo + _CHUNK + K - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        inner = _rolling(codes, S)
        smallest = _window_min(inner, K - S + 1)
        chosen = np.flatnonzero((inner[:len(smallest)] == smallest) | (inner[K - S:] == smallest))
        positions.append(chosen + lo)
        hashes.append(_doubled(codes)[chosen])
    return np.concatenate(positions), np.concatenate(hashes)


def _or_whole(text: str, positions: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(hashes) and text:
        positions = np.zeros(1, np.int64)
        hashes = np.array([xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint64)
    return positions, (hashes >> np.uint64(32)).astype(np.uint32)


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes of the closed syncmers of a text.

    A string of K characters is one if the smallest hash of its inner strings of S characters is
    that of its first or its last. This depends on the string alone, so a passage has the same
    anchors wherever it stands; of any K - S + 1 neighbouring strings one at least is chosen. A
    text shorter than K, or without any, has itself as its only anchor, an empty one none.
    """
    return _or_whole(text, *_syncmers(text))


def anchors_after_edit(text: str, found: tuple[np.ndarray, np.ndarray], kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of a text that shares its first ``kept`` characters with one whose syncmers are ``found``."""
    same = found[0] <= kept - K
    lo = max(0, kept - K + 1)
    positions, hashes = _syncmers(text[lo:])
    return _or_whole(text, np.concatenate([found[0][same], positions + lo]), np.concatenate([found[1][same], hashes]))


def _window_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` values in a row, by doubling."""
    out, have = values, 1
    while 2 * have <= size:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    rest = size - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def encode(hashes: np.ndarray) -> str:
    """The fingerprint: the anchors' hashes in text order, four bytes each, in base 64."""
    return base64.b64encode(hashes.astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Each anchor with the number of its occurrence, so that none repeats."""
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.r_[True, hashes[order][1:] != hashes[order][:-1]])
    number = np.empty(len(hashes), np.uint64)
    number[order] = np.arange(len(hashes)) - np.repeat(first, np.diff(np.r_[first, len(hashes)]))
    return hashes.astype(np.uint64) << np.uint64(32) | number


def _rising(places: np.ndarray) -> int:
    """Length of the longest rising subsequence of distinct numbers."""
    if (places[1:] > places[:-1]).all():
        return len(places)
    ends: list[int] = []  # smallest last number of a rising subsequence of each length
    for p in places.tolist():
        at = bisect_left(ends, p)
        ends[at:at + 1] = [p]
    return len(ends)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the number of anchors that both have in the same order, over that of all; two empty texts: 1.

    The k-th occurrence of an anchor is matched with the k-th one, and of the matches the longest
    run in order counts: a passage that has moved counts on one side of what it moved over. What
    both have in any order bounds it from above.
    """
    if not len(a) + len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(_numbered(a), _numbered(b), assume_unique=True, return_indices=True)
    return 2 * _rising(j[np.argsort(i)]) / (len(a) + len(b)) if len(i) else 0.0


def aligned(a: str, b: str) -> tuple[int, float]:
    """The shift between two texts that most of their common anchors agree on, and their share."""
    (p, x), (q, y) = anchors(a), anchors(b)
    where: dict[int, list[int]] = {}
    for i, h in zip(q.tolist(), y.tolist()):
        where.setdefault(h, []).append(i)
    votes = Counter(j - i for i, h in zip(p.tolist(), x.tolist()) for j in where.get(h, ()))
    if not votes:
        return 0, 0.0
    shift, n = min(votes.items(), key=lambda v: (-v[1], abs(v[0]), v[0]))
    return shift, n / max(len(x), len(y))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with fingerprint (text) and n_anchors; columns of these names are replaced.

    Null and empty texts have an empty fingerprint. Equal texts have equal ones.
    """
    @F.arrow_udf("struct<fingerprint: string, n_anchors: int>")
    def make(texts: pa.Array) -> pa.Array:
        found = [anchors(t or "")[1] for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([encode(h) for h in found], pa.string()),
                                           pa.array([len(h) for h in found], pa.int32())], ["fingerprint", "n_anchors"])

    others = [c for c in docs.columns if c not in ("fingerprint", "n_anchors")]
    return docs.withColumn("_llm_made", make("text")).select(*others, "_llm_made.fingerprint", "_llm_made.n_anchors")


def _bucket(bounds: list[int], column: Column) -> Column:
    """How many of the sorted bounds lie at or below the value, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.lit(bounds).cast("array<bigint>")

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        lower = s["value"] < F.get(table, middle)
        return F.when(s["lo"] == s["hi"], s).otherwise(F.struct(
            F.when(lower, s["lo"]).otherwise(middle + 1).alias("lo"), F.when(lower, middle).otherwise(s["hi"]).alias("hi"), s["value"].alias("value")))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"), column.cast("bigint").alias("value"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(bounds).bit_length())), start, halve, lambda s: s["lo"])


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its fingerprint and those of an edit and of the next row.

    Ids are whole numbers. The edited text has its last quarter (floor(n / 4) code points) replaced by the first as many,
    or all, of the next document by id; the last one's next is the first. Columns: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (likeness to
    the edited text's and to the next document's).

    Null texts are empty. Rows of equal ids follow each other by text; null ids come first. Ids
    are dealt to ranges by quantiles, so each task goes through its rows in order; the first row
    of a range is also sent to the range before it. The only row of a table is its own next.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    wanted = max(1, partitions(spark) * BUCKETS_PER_TASK)
    cuts = rows.filter("doc_id IS NOT NULL").stat.approxQuantile(
        "doc_id", [i / wanted for i in range(1, wanted)], 1 / (4 * wanted)) if wanted > 1 else []
    # As many numbers as there are ranges, whatever the number of rows.
    bounds = sorted({int(x) for x in cuts or []})
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(_bucket(bounds, F.col("doc_id")))
    named = rows.withColumn("bucket", bucket)
    heads = (named.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("head"))
             .orderBy("bucket").collect())
    if not heads:
        return docs.limit(0).select("doc_id", *[F.lit(None).cast(k).alias(c) for c, k in (
            ("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"),
            ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"))])
    order = [h["bucket"] for h in heads]
    before = {b: order[i - 1] for i, b in enumerate(order)}
    previous = F.element_at(F.create_map(*[F.lit(x) for b in order for x in (b, before[b])]), F.col("bucket"))
    first_ids = [h["head"]["doc_id"] for h in heads if h["head"]["known"]]
    is_head = F.col("doc_id").isin(first_ids) if first_ids else F.lit(False)
    if any(not h["head"]["known"] for h in heads):
        is_head = F.col("doc_id").isNull() | is_head
    # guest: a copy of a range's first rows, for the range before it
    guest = F.explode(F.when(is_head, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    sent = named.select("doc_id", "text", "bucket", guest.alias("guest"))
    sent = sent.withColumn("bucket", F.when(F.col("guest"), previous).otherwise(F.col("bucket")))
    by = ["bucket", "guest", "doc_id", "text"]
    dealt = sent.repartition(partitions(spark), "bucket").sortWithinPartitions(*by)

    def run(batches):
        held = None  # (bucket, doc_id, text, syncmers, anchors) of the row whose next one is awaited
        out: list[tuple] = []
        for batch in batches:
            ids, texts, buckets, guests = (batch.column(i).to_pylist() for i in range(4))
            for doc_id, text, b, g in zip(ids, texts, buckets, guests):
                if g and (held is None or held[0] != b):
                    continue  # later guests of a range
                raw = _syncmers(text)
                mine = _or_whole(text, *raw)[1]
                if held is not None:
                    _, left, old, old_raw, old_anchors = held
                    n = len(old) // 4
                    edited = old[:len(old) - n] + text[:n]
                    changed = anchors_after_edit(edited, old_raw, len(old) - n)[1]
                    out.append((left, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                encode(old_anchors), encode(changed), likeness(old_anchors, changed), likeness(old_anchors, mine)))
                held = None if g else (b, doc_id, text, raw, mine)
                if len(out) >= 2000:
                    yield _batch(out, kind)
                    out = []
        if out:
            yield _batch(out, kind)

    kind = batch_type(dict(docs.dtypes)["doc_id"])
    return dealt.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_chars long, edited_sha256 string, "
                                 "fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def batch_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32()}[name]


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
