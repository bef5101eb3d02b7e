"""Connected components of a graph given as a table of links, as repeated DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.sources.tables import stage


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of (a, b): label is the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then the label of that label, so long chains shorten
    by half; the table of labels is written to the shared folder each round, which cuts the lineage. A node with very
    many links is pre-aggregated before the shuffle, and its side of the join is split by adaptive execution.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = stage(both, "links")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("least"))
        closer = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "least").alias("label"))
        beyond = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        jumped = closer.join(beyond, closer.label == beyond["at"]).select("node", "old", F.least("label", "next").alias("label"))
        jumped = stage(jumped, "labels")
        moved = jumped.where("label <> old").limit(1).count()
        labels = jumped.select("node", "label")
        if not moved:
            return labels
