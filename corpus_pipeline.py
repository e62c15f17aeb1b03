"""From raw documents to a training mix: five operators of the llm subpackage, one after the other.

Each stage takes the documents its predecessor kept, written as Parquet in the shared folder and
read again. Nulls, empty texts, ties, repeated rows and empty tables go as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.llm import decontamination, jaccard, lines, mixing, toxicity
from wellspark.session import shared_folder
from wellspark.sources.files import discard


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the two letter models do not call toxic."""
    scored = toxicity.score_toxicity(docs, _table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more share; n_chars follows."""
    out = lines.drop_repeated_lines(docs)
    new = {"text": F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text")),
           "n_chars": F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(F.col("n_chars"))}
    kinds = dict(docs.dtypes)
    return out.select(*[new[c].cast(kinds[c]).alias(c) if c in new else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return jaccard.one_per_component(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many documents again, equally many of each source on average, in random order."""
    return mixing.poisson_mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("source_mixing", mix_sources),
]

ORACLE_SQL = None  # a fitted model and a hash-seeded draw are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = _table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            discard(spark, last)
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
