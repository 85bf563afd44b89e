"""Connected components of a large, sparse graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import drop_staged, stage


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for each node of ``edges`` (a, b).

    Each round lets every node follow its smallest neighbour, follows that node's choice
    too, and contracts the graph to the nodes followed, which at least halves it. Rows of
    a node with many neighbours meet only as partial minima and in plain joins, which
    Spark splits. Edges with a null end or equal ends count as none.
    """
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    pairs = stage(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    labels = None
    while True:
        smallest = pairs.groupBy("a").agg(F.min("b").alias("b"))
        chosen = smallest.select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        chosen = stage(chosen, "chosen")
        beyond = chosen.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        follow = chosen.join(beyond, "root").select("node", F.col("beyond").alias("root"))
        follow = stage(follow, "follow")
        if labels is None:
            labels = follow
        else:
            later = follow.select(F.col("node").alias("root"), F.col("root").alias("later"))
            old = labels
            labels = old.join(later, "root", "left").select(
                "node", F.coalesce("later", "root").alias("root")
            )
            labels = stage(labels, "labels")
            drop_staged(old)
        at_a = follow.select(F.col("node").alias("a"), F.col("root").alias("to_a"))
        at_b = follow.select(F.col("node").alias("b"), F.col("root").alias("to_b"))
        old = pairs
        pairs = (
            old.join(at_a, "a")
            .join(at_b, "b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        pairs = stage(pairs, "edges")
        drop_staged(old)
        drop_staged(chosen)
        if follow is not labels:
            drop_staged(follow)
        if pairs.isEmpty():
            return labels
