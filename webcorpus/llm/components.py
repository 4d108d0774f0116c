"""Connected components of an edge table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import cut


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``edges(a, b)`` → ``(node, label)``: for each node that has an edge, the
    smallest node of its component.

    Each round takes the smallest label among a node and its neighbours
    (partial minima before the shuffle), then looks up that label's own label,
    which halves long chains.  The table of a round is written to the shared
    folder; the driver sees one count a round.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen")))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                 F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = cut(lower.join(jump, "label", "left").select(
            "node", "old", F.least("label", "further").alias("label")))
        labels = after.select("node", "label")
        if after.where("label < old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
