"""Line de-duplication with a once-seen and a twice-seen Bloom filter."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.shared import in_filter, scratch, shared_table, text_bytes, twice_seen

FILTER_BITS = 1 << 27  # 16 MB for each filter
SALTS = 16
_BLANK = b" \t\n\x0b\x0c\r"


def _keys(text: bytes) -> dict[bytes, list[int]]:
    """Line numbers by key: the line without blanks at its ends, A-Z lower-cased."""
    found: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split(b"\n")):
        found.setdefault(line.strip(_BLANK).lower(), []).append(i)
    return found


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def repeated_lines(docs: DataFrame, min_documents: int = 10, min_length: int = 1,
                   keep_first: bool = False, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Where lines of ``docs`` (doc_id, text) repeat: doc_id, text_hash, lines (array of int).

    Two Bloom filters of a fixed size find lines seen in two documents or more; only these
    suspects are shuffled, with their whole text, and counted exactly. A row is a document: rows
    with the same id and text count each for itself and get the same lines. With ``keep_first``
    the occurrence with the smallest (doc_id, text_hash, line) stays; otherwise every line goes.

    Null texts are empty. A key shorter than ``min_length`` code points is never dropped. An empty
    table gives an empty result.
    """
    with scratch(docs.sparkSession):
        return shared_table(_repeated_lines(docs, min_documents, min_length, keep_first, filter_bits), stays=True)


def _repeated_lines(docs: DataFrame, min_documents: int, min_length: int, keep_first: bool, filter_bits: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")

    def wanted(text: bytes) -> dict[bytes, list[int]]:
        return {k: v for k, v in _keys(text).items()
                if len(k) >= min_length and (len(k) >= 4 * min_length
                                             or len(k.decode("utf-8", "replace")) >= min_length)}

    def hashed(batches):
        for batch in batches:
            h = [_hashes(wanted(t)) for t in text_bytes(batch)]
            values, n = np.unique(np.concatenate(h) if h else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n > 1)], ["h", "twice"])

    filled = spark.sparkContext.broadcast(
        twice_seen(rows.select("text").mapInArrow(hashed, "h long, twice boolean"), filter_bits))

    def suspects(batches):
        for batch in batches:
            at, keys, numbers = [], [], []
            for i, text in enumerate(text_bytes(batch)):
                found = wanted(text)
                if found:
                    for hit, (key, lines) in zip(in_filter(filled.value, _hashes(found)), found.items()):
                        if hit:
                            at.append(i)
                            keys.append(key)
                            numbers.append(lines)
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken),
                 pa.array(keys, pa.binary()), pa.array(numbers, pa.list_(pa.int32()))],
                ["doc_id", "text_hash", "key", "lines"])

    kind = dict(docs.dtypes)["doc_id"]
    suspected = shared_table(rows.mapInArrow(
        suspects, f"doc_id {kind}, text_hash long, key binary, lines array<int>"))
    filled.destroy()
    place = F.struct("doc_id", "text_hash", F.col("lines")[0].alias("line"))
    counted = [F.count("*").alias("n"), *([F.min(place).alias("first")] if keep_first else [])]
    confirmed = suspected.groupBy("key").agg(*counted).filter(F.col("n") >= min_documents).drop("n")
    # A line may be in a third of all documents, so its occurrences are dealt out by a salt.
    salted = confirmed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = suspected.withColumn("salt", F.pmod("text_hash", F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])
    if keep_first:
        own = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash"))
        first = F.col("first.line")
        hits = hits.withColumn("lines", F.when(
            own, F.filter("lines", lambda x: x != first)).otherwise(F.col("lines")))
    return hits.groupBy("doc_id", "text_hash").agg(
        F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))


def drop_repeated_lines(docs: DataFrame, min_documents: int = 10, min_length: int = 1,
                        keep_first: bool = False, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with the new columns kept (text), n_lines and n_dropped.

    See ``repeated_lines`` for what goes. Columns of ``docs`` with these three names are replaced;
    all others stay. A null or empty text is one empty line; when all lines go, kept is empty.
    """
    gone = repeated_lines(docs, min_documents, min_length, keep_first, filter_bits)
    gone = gone.select(F.col("doc_id").alias("_llm_doc_id"), F.col("text_hash").alias("_llm_text_hash"),
                       F.col("lines").alias("_llm_gone"))
    text = F.coalesce("text", F.lit(""))
    both = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_llm_doc_id"])
                     & (F.xxhash64(text) == gone["_llm_text_hash"]), "left")
    new = ("kept", "n_lines", "n_dropped")
    lines, dropped = F.col("_llm_lines"), F.col("_llm_gone")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    return (both.withColumn("_llm_lines", F.split(text, "\n"))
            .select(*[c for c in docs.columns if c not in new],
                    F.when(dropped.isNull(), text).otherwise(
                        F.array_join(F.transform(stay, lambda i: lines[i]), "\n")).alias("kept"),
                    F.size(lines).cast("long").alias("n_lines"),
                    F.when(dropped.isNull(), 0).otherwise(F.size(dropped)).cast("long").alias("n_dropped")))
