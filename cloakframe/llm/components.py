"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.stage import saved


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (least node reachable) of every node that ``links`` (a, b) names.

    Each round takes the least label among a node and its neighbours and then the label of that
    label, so a chain of n links takes about log n rounds.  Nothing but two counts reaches the driver.
    """
    edges = saved(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = saved(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        near = edges.join(labels, edges.b == labels.node).select(F.col("a").alias("node"), "component")
        least = near.union(labels.select("node", "component")).groupBy("node").agg(F.min("component").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        new = saved(least.join(up, "component").select("node", F.least("component", "next").alias("component")))
        changed = new.join(labels.withColumnRenamed("component", "old"), "node").where("component <> old").limit(1).count()
        labels = new
        if not changed:
            return labels
