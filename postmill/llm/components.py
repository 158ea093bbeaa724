"""Connected components of a table of links, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.session import stage


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of all nodes of ``links`` (a, b: long).

    Each round every node takes the smallest label among its neighbours and then the label of its
    label, so labels travel twice as far each round. The labels of a round are written, so that a
    lost executor costs one round. A node with very many links is a hot join key of two plain
    inputs, which adaptive execution splits, and its labels are reduced before they are shuffled.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    both = stage(both, "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "component"), "b")
        least = seen.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        moved = labels.join(jump, "component").join(least, "node")
        fresh = moved.select(
            "node", F.least("component", "far", "near").alias("component"), (F.col("component") > F.least("far", "near")).alias("moved")
        )
        labels = stage(fresh, "labels")
        if labels.filter("moved").isEmpty():
            return labels.select("node", "component")
