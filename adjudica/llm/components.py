"""Connected components by repeated contraction, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); two nodes are connected if and only if labels are equal.

    In each round every node goes over to the least of itself and its neighbours, and edges follow their ends. Least is
    by a hash of the node, so whatever the nodes are called only those below all their neighbours are left, a steady
    share, and rounds grow with the logarithm of the number of nodes. What a round leaves is written and read again, so
    the planner sees each round's true size and plans stay as small as the first; only "any left" reaches the driver.
    Neighbours are summed up before a shuffle (minimum), so a node with very many edges is no burden.
    """
    named = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    rest = written(edges.where("a <> b").select(named("a").alias("a"), named("b").alias("b")).distinct(), "components")
    labels = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        moves = written(least.select(F.col("a").alias("node"), F.least("a", "low").alias("to")), "components")
        if labels is None:
            labels = moves.select("node", F.col("to").alias("label"))
        else:
            on = moves.select(F.col("node").alias("label"), "to")
            labels = written(labels.join(on, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "components")
        a = moves.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        b = moves.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        one = rest.join(a, "a").select("to_a", "b").join(b, "b").where("to_a <> to_b")
        rest = written(one.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), "components")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    return labels.select(F.col("node.id").alias("node"), F.col("label.id").alias("label"))
