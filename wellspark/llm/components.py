"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.shared import shared_table


def components(edges: DataFrame) -> DataFrame:
    """Per node of ``edges`` (a, b: long): node, component, its smallest reachable node.

    ``edges`` is read several times, so it should be a stored table. Each round takes the smallest
    label among those of a node's neighbours and of the node that its own label names, so chains
    shrink to a fraction of their length; the loop ends when no label changes. Null ends and
    loops are ignored; an empty table gives an empty result. The join on a hot node has a few
    columns and is split by Spark's adaptive skew handling.
    """
    one_way = edges.select("a", "b").filter("a <> b")
    both = one_way.union(one_way.select("b", "a"))
    smallest = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = shared_table(smallest.select(F.col("a").alias("node"), F.least("a", "b").alias("component")))
    if labels.isEmpty():
        return labels
    while True:
        # The label is one more neighbour; what it was tells whether it has changed.
        own = labels.select(F.col("node").alias("a"), F.col("component").alias("b"), F.col("component").alias("was"))
        steps = both.select("a", "b", F.lit(None).cast("long").alias("was")).union(own)
        found = steps.join(labels, steps["b"] == labels["node"]).groupBy("a").agg(
            F.min("component").alias("component"), F.min("was").alias("was"))
        new = shared_table(found.select(F.col("a").alias("node"), "component", (F.col("component") != F.col("was")).alias("moved")))
        labels = new.select("node", "component")
        if new.filter("moved").isEmpty():
            return labels
