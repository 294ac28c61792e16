"""Connected components by smallest label, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import release, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(node, component)``, component being the smallest
    node reachable. Nodes without a link don't appear.

    Each pass takes the smallest label among the neighbours and then the
    label of that label, so long chains halve. Every pass is cut off from the
    ones before it by a checkpoint, and its joins start from plain tables, so
    that Spark can split a hot hub.
    """
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(
        edges.select(F.col("b").alias("src"), F.col("a").alias("dst"))
    )
    both = stored(both.where("src <> dst").distinct())
    labels = stored(
        both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m")).select("node", F.least("node", "m").alias("component"))
    )
    kept = labels
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "dst").hint("merge"), "dst")
            .groupBy(F.col("src").alias("node"))
            .agg(F.min("component").alias("m"))
        )
        step = labels.join(near.hint("merge"), "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("up"))
        top = labels.select(F.col("node").alias("up"), F.col("component").alias("t"))
        new = stored(
            step.join(top.hint("merge"), "up", "left").select("node", F.least("up", F.coalesce("t", "up")).alias("component"), "old")
        )
        if new.where("component <> old").isEmpty():
            release(both, new)
            return labels  # they did not change
        release(kept)
        kept, labels = new, new.select("node", "component")
