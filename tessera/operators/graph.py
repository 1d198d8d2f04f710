"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedupe import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the least node names a component.

    Every round ties each node's larger neighbours, then its smaller ones, to the least of them, so the
    rounds grow with the logarithm of a component's length and not with it.  A round is two grouped
    minima and two joins back; it ends when a round changes no edge.  Self-loops count as nodes.
    """
    alone = edges.filter("a = b").select(F.col("a").alias("node")).distinct()
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    before = None
    while True:
        seen = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first())
        if seen == before:
            break
        before = seen
        around = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("node", "other")
        least = around.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("low"))
        larger = around.filter("other > node").join(least, "node").select(F.col("other").alias("high"), "low").distinct()
        least = larger.groupBy("high").agg(F.min("low").alias("to"))
        smaller = larger.join(least, "high").select(F.when(F.col("low") == F.col("to"), F.col("high")).otherwise(F.col("low")).alias("high"), F.col("to").alias("low"))
        edges = checkpointed(smaller.filter("high <> low").distinct())
    found = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node")).unionByName(alone).distinct().join(found, "node", "left_anti")
    return found.unionByName(roots.select("node", F.col("node").alias("component")))
