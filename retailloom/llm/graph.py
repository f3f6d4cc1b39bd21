"""Connected components by minimum labels and pointer jumps, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``node, component``: the smallest node reachable. Nodes without an edge do not occur.

    Each round gives a node the smallest label among its neighbours and then the label of that label, so the
    rounds follow the logarithm of the longest path. A node with very many edges is summed before the shuffle,
    and its rows in the join are split by AQE. Labels are written every round: a lost executor costs one round.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a != b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                         .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("component").alias("near")))
        lower = materialize(
            labels.join(near, "node")
            .select("node", "component", F.least("component", "near").alias("lower")), "lower")
        target = lower.select(F.col("node").alias("lower"), F.col("lower").alias("lowest"))
        jumped = materialize(
            lower.join(target, "lower")
            .select("node", F.col("lowest").alias("component"), (F.col("component") != F.col("lowest")).alias("moved")),
            "labels")
        labels = jumped.select("node", "component")
        if jumped.where("moved").isEmpty():
            return labels
