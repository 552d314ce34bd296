"""Connected components of an undirected graph given as an edge table.

Rounds of contraction: every vertex hooks to the neighbour (or itself) of smallest hash
rank, then edges are rewritten to the hooks and loops and repeats dropped. In random rank
order a round removes a constant share of the vertices, also on long chains, so the number
of rounds grows with the logarithm of the longest component. Each round is a grouped
minimum (combined before its shuffle, so a hub costs no more than its task count) and
equi-joins that adaptive execution splits when a hub is hot; its outcome is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, root): one row per vertex that has an edge to another vertex.

    Rows of one component share ``root``, an arbitrary vertex of it. Loops, nulls and
    repeated edges are ignored; an empty table gives an empty result.
    """
    rank = lambda c: F.xxhash64(c)
    graph = (edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
             .filter("a is not null and b is not null and a <> b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .distinct().checkpoint())
    nodes = None
    while not graph.isEmpty():
        hooks = (graph.select("a", "b").union(graph.select("b", "a"))
                 .groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("v"))).alias("m"))
                 .select(F.col("a").alias("v"), F.when(
                     F.col("m") < F.struct(rank("a").alias("r"), F.col("a").alias("v")), F.col("m.v"))
                     .otherwise(F.col("a")).alias("to"))
                 .checkpoint())
        if nodes is None:
            nodes = hooks.select(F.col("v").alias("node"), F.col("to").alias("root"))
        else:
            nodes = (nodes.join(hooks, nodes["root"] == hooks["v"], "left")
                     .select("node", F.coalesce("to", "root").alias("root")).checkpoint())
        left = hooks.select(F.col("v").alias("a"), F.col("to").alias("ta"))
        right = hooks.select(F.col("v").alias("b"), F.col("to").alias("tb"))
        graph = (graph.join(left, "a").join(right, "b")
                 .filter("ta <> tb")
                 .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                 .distinct().checkpoint())
    if nodes is None:
        return graph.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes
