"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.llm.shared import fraction, partitions, shared_table

SEED = "mix"
LARGEST = 64.0  # a larger mean is drawn as a sum of parts of at most this mean


def poisson(mean: Column, *draws: Column) -> Column:
    """The smallest k whose distribution function reaches the draw, a number in [0, 1).

    With several draws, the sum of as many variables of an equal part of the mean each.
    """
    part = mean / F.lit(float(len(draws)))

    def one(u: Column) -> Column:
        # Steps beyond mean + 12 roots + 24 have a chance below what a double can tell from 1.
        steps = F.ceil(part + 12 * F.sqrt(part) + 24).cast("int")
        # The draw travels with the sum, so that its hash is taken once.
        start = F.struct(F.exp(-part).alias("p"), F.exp(-part).alias("cdf"), F.lit(0).alias("k"), u.alias("u"))

        def step(s: Column, i: Column) -> Column:
            p = s["p"] * part / i
            return F.when(s["cdf"] > s["u"], s).otherwise(F.struct(
                p.alias("p"), (s["cdf"] + p).alias("cdf"), (s["k"] + 1).alias("k"), s["u"].alias("u")))

        return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda s: s["k"])

    total = one(draws[0])
    for u in draws[1:]:
        total = total + one(u)
    return F.when(mean > 0, total).otherwise(0)


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0) -> DataFrame:
    """Per source: source, n (rows), rate: how often a row of it is repeated on average.

    The mix is to have ``size`` times the rows of ``docs``, shared out by weight; a source that
    ``weights`` does not name has weight 0, and without ``weights`` all weigh the same. Weights
    below 0 are refused. Null is a source like any other; it cannot be named.
    """
    if weights is not None and any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    weight = F.lit(1.0)
    if weights is not None:
        named = [x for k, w in weights.items() for x in (F.lit(k), F.lit(float(w)))]
        weight = F.coalesce(F.element_at(F.create_map(*named), F.col("source")), F.lit(0.0)) if named else F.lit(0.0)
    counts = shared_table(counts.withColumn("weight", weight))
    total = counts.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weight")).first()
    if not total["weight"]:
        return counts.select("source", "n", F.lit(0.0).alias("rate"))
    return shared_table(counts.select("source", "n", (
        F.col("weight") * (size * total["rows"] / total["weight"]) / F.col("n")).alias("rate")))


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0,
                seed: str = SEED) -> DataFrame:
    """``docs`` with every row repeated by a Poisson draw, in random order; adds copy (1, 2, ...).

    The mean of the draw is the row's source's rate (see ``repetition_rates``); the draw depends
    on the seed, doc_id and text alone, so a lost task draws the same again. Rows of the same id
    and text draw the same. Each copy goes to a partition and a place in it by a hash of its own.
    A column called copy is replaced. Sources without weight are left out; null texts count as
    any; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rates = repetition_rates(docs, weights, size)
    most = rates.agg(F.max("rate")).first()[0] or 0.0
    draws = [fraction(f"{seed} {i}", "doc_id", "text") for i in range(max(1, -(-int(most + 1) // int(LARGEST))))]
    # The rates are a table of known size: Spark broadcasts it below its own limit and splits a
    # hot source otherwise.
    rates = rates.select(F.col("source").alias("_llm_source"), F.col("rate").alias("_llm_rate")).filter("_llm_rate > 0")
    rows = docs.join(rates, docs["source"].eqNullSafe(rates["_llm_source"]))
    kept = [c for c in docs.columns if c != "copy"]
    copies = rows.withColumn("_llm_n", poisson(F.col("_llm_rate"), *draws)).filter("_llm_n > 0")
    copies = copies.select(*kept, F.explode(F.sequence(F.lit(1), F.col("_llm_n"))).alias("copy"))
    place = F.xxhash64(F.lit(f"{seed} place"), "doc_id", "text", "copy")
    return (copies.withColumn("_llm_place", place).repartition(partitions(spark), "_llm_place")
            .sortWithinPartitions("_llm_place").drop("_llm_place"))
