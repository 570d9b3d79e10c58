"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dockgrid.llm.common import settle


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, label (the smallest node of its component) for the nodes of edges (a, b). Raises if labels still move after most_rounds.

    Each round takes the smallest label among neighbours and then the label of that label, so long chains halve.
    """
    edges = settle(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = settle(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    for _ in range(most_rounds):
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        best = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("best"), F.col("label").alias("old"))
        up = labels.select(F.col("node").alias("up_node"), F.col("label").alias("up_label"))
        after = settle(best.join(up, best["best"] == up["up_node"], "left").select("node", F.least("best", F.coalesce("up_label", "best")).alias("label"), "old"), "labels")
        moved = after.filter("label <> old").isEmpty()
        labels = after.select("node", "label")
        if moved:
            return labels
    raise RuntimeError(f"labels still move after {most_rounds} rounds")
