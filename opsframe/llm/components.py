"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.storage import cut_lineage


def connected_components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``; the label is the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then the label of that label, so paths shrink
    by half a round.  Links and labels are written between rounds: adaptive execution may split the links of a
    hub, and nothing is computed again when an executor is lost.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a <> b").distinct()
    both = cut_lineage(both, "links")
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        near = seen.join(labels, "node").select("node", F.least("near", "label").alias("near"), "label")
        near = cut_lineage(near, "near")
        target = near.select(F.col("node").alias("at"), F.col("near").alias("next"))
        jumped = near.join(target, near["near"] == target["at"])
        moved = jumped.select("node", F.least("near", "next").alias("label"), F.col("label").alias("old"))
        moved = cut_lineage(moved, "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
