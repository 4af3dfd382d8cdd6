"""Connected components of a link table, by contraction: every step is a join or an aggregate, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable over ``links`` (a, b); only linked nodes are returned.

    Each round points every node at its smallest neighbour, follows the pointers to their ends by doubling, and links
    the ends; components at least halve. Rounds are written to the shared folder.
    """
    edges = stage(links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if edges.isEmpty():
            return labels if labels is not None else both.select(F.col("a").alias("node"), F.col("b").alias("root"))
        parent = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).select(F.col("a").alias("node"), "p"), "parents")
        while True:  # pointers only go down, so they end at nodes that point at themselves
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("q"))
            jumped = stage(parent.join(up, "p").select("node", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), "parents")
            parent = jumped.select("node", "p")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parent.select("node", F.col("p").alias("root"))
        else:
            to = parent.select(F.col("node").alias("root"), F.col("p").alias("next"))
            labels = stage(labels.join(to, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        ends = edges.join(parent.select(F.col("node").alias("a"), F.col("p").alias("pa")), "a").join(parent.select(F.col("node").alias("b"), F.col("p").alias("pb")), "b")
        edges = stage(ends.where("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
