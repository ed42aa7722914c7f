"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import merged, settle


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) of every node of an edge table (a, b); component is the smallest node.

    Each round a node takes the smallest label among its own and its
    neighbours', and then the label of its label, so stars and chains shrink fast. State is a table in the shared
    folder after each round. Neighbours' labels are joined by plain equi-joins (a hot node's edges can be split) and
    pre-aggregated before the shuffle.
    """
    both = settle(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = settle(both.groupBy("a").agg(F.min("b").alias("least"))
                    .select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels")
    for _ in range(rounds):
        offered = (both.join(merged(labels.select(F.col("node").alias("b"), "component")), "b")
                   .groupBy("a").agg(F.min("component").alias("offer")).withColumnRenamed("a", "node"))
        hooked = settle(labels.join(merged(offered), "node").select(
            "node", F.least("component", "offer").alias("component"), F.col("component").alias("was")), "hooked")
        parent = hooked.select(F.col("node").alias("up"), F.col("component").alias("up_component"))
        jumped = settle(hooked.join(merged(parent), F.col("component") == F.col("up"))
                        .select("node", F.least("component", "up_component").alias("component"), "was"), "labels")
        if jumped.where("component != was").isEmpty():
            return jumped.select("node", "component")
        labels = jumped.select("node", "component")
    raise RuntimeError("components did not settle")
