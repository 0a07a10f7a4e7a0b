"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.sources.workspace import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (a, b): the root is the smallest node that can be reached.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so the rounds grow with the logarithm of the longest
    path. Every round is a written table; nothing is gathered on the driver.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = settle(both.union(both.select("other", "node")).filter("node <> other").distinct(), "links")
    labels = settle(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "root"), "other")
            .groupBy("node").agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels_next = settle(
            lower.join(jump, "root", "left").select("node", F.least("root", F.coalesce("next", "root")).alias("root"), "old"),
            "labels",
        )
        changed = labels_next.filter("root <> old").limit(1).count()
        labels = labels_next.select("node", "root")
        if not changed:
            return labels
