"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlode.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for links (a, b): the smallest node of each component, for every node with a link.

    Each round a node takes the smallest label around it, then the label of that label; a chain
    halves per round. Labels are written out each round, so lineage stays short; only the number of
    changed labels reaches the driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = stored(labels.select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("low"))
        nearer = labels.join(around.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = nearer.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")
        )
        moved = stored(moved, "labels")
        changed = moved.where("label <> old").count()
        labels = moved.select("node", "label")
        if not changed:
            return labels
