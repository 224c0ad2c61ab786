"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.session import staged


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, label`` of every node in ``edges(u, v)``; the label is the component's smallest node.

    Each round takes the smallest label among a node and its neighbours and
    then that label's own label, so rounds grow with the logarithm of the
    longest path. Rounds are staged; nothing but a count comes to the driver.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    links = staged(both.unionByName(both.select("u", F.col("u").alias("v"))).distinct(), f"{name}-links")
    labels = staged(links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = (links.join(labels, links.v == labels.node).groupBy("u").agg(F.min("label").alias("label"))
                .select(F.col("u").alias("node"), "label"))
        up = labels.select(F.col("node").alias("at"), F.col("label").alias("up"))
        fresh = (near.join(up, near.label == up["at"]).select("node", F.col("up").alias("label")))
        old = labels.select(F.col("node").alias("own"), F.col("label").alias("was"))
        step = staged(fresh.join(old, F.col("node") == F.col("own")).select("node", F.least("label", "was").alias("label"), "was"),
                      f"{name}-{turn}")
        labels = step.select("node", "label")
        if step.where(F.col("label") != F.col("was")).isEmpty():
            return labels
