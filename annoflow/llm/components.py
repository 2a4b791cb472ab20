"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from annoflow.session import written


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (smallest node of it) of every node of ``links``.

    Each round gives every node the smallest label among its neighbours and then
    the label of that label; labels halve their way down chains, so the rounds
    grow with the logarithm of the longest chain. All sums are partial before
    they are shuffled, so a node with very many links is no hot spot.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = both.union(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x != y").distinct()
    both = written(both, "links")
    labels = written(
        both.groupBy("x").agg(F.min("y").alias("least")).select(F.col("x").alias("node"), F.least("x", "least").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("y"), "component"), "y")
            .groupBy(F.col("x").alias("node")).agg(F.min("component").alias("near"))
        )
        # hooking the old label to the smallest one near it moves whole trees at once
        hooks = (
            labels.join(near, "node").groupBy(F.col("component").alias("root")).agg(F.min("near").alias("near"))
        )
        moved = (
            labels.withColumnRenamed("component", "old").join(near, "node")
            .join(hooks.select(F.col("root").alias("old"), F.col("near").alias("hook")), "old", "left")
            .select("node", "old", F.least("old", "near", "hook").alias("component"))
        )
        jumped = moved.join(
            moved.select(F.col("node").alias("component"), F.col("component").alias("further")), "component", "left"
        ).select("node", "old", F.least("component", F.coalesce("further", "component")).alias("component"))
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("old != component").isEmpty():
            return labels
