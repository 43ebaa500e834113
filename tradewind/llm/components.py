"""Connected components of a graph of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """node, label for the nodes of `links` (a, b): label is the least node of the node's component.

    Each round takes the least label among a node and its neighbours, then the label of that label, until nothing
    changes. Labels are written after each round; only their number of changes comes to the driver. Nulls are no
    nodes; repeated links and links of a node with itself do no harm; no links give no rows.
    """
    links = links.where("a is not null and b is not null").select(F.col("a").alias("node"), F.col("b").alias("neighbour"))
    ways = written(links.unionByName(links.select(F.col("neighbour").alias("node"), F.col("node").alias("neighbour"))).distinct(), "ways")
    labels = written(ways.groupBy("node").agg(F.min(F.least("node", "neighbour")).alias("label")), "labels")
    while True:
        known = labels.select(F.col("node").alias("neighbour"), "label")
        near = ways.join(known, "neighbour").groupBy("node").agg(F.min("label").alias("near"))
        least = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = least.join(jump, "label", "left").select("node", F.least("label", "further").alias("label"), "before")
        labels = written(labels, "labels")
        if labels.where("label <> before").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
