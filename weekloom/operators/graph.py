"""Connected components by smallest label, with each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.session import stored


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node reaches. nodes: node; links: a, b."""
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = stored(nodes.select("node", F.col("node").alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.least("component", F.coalesce("near", "component")).alias("label"), F.col("component").alias("was"))
        # Take the label of one's label as well, which halves the way to the smallest node.
        jump = step.select(F.col("node").alias("at"), F.col("label").alias("onward"))
        step = step.join(jump, F.col("label") == F.col("at"), "left").select("node", F.least("label", F.coalesce("onward", "label")).alias("component"), "was")
        step = stored(step, "labels")
        if not step.where("component <> was").limit(1).count():
            return step.select("node", "component")
        labels = step.select("node", "component")
