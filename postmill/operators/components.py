"""Groups of rows that links connect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.session import stage


def connected(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, group): the smallest node that links reach, for every node of ``links``.

    Every round points each node at the smallest group in its neighbourhood and then at that
    group's own group, which halves long chains. A round's table is written, so that a lost
    executor costs that round. Both inputs of the join are plain, so AQE can split the links of a
    hot node; its neighbours are reduced to one row per task before they are shuffled.
    """
    there = links.select(F.col(left).alias("node"), F.col(right).alias("other"))
    edges = stage(there.union(there.select("other", "node")).filter("node <> other").distinct(), "edges")
    groups = stage(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("group")), "groups")
    while True:
        offered = edges.join(groups.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("group").alias("offer"))
        of_group = groups.select(F.col("node").alias("group"), F.col("group").alias("above"))
        found = groups.join(of_group, "group").join(offered, "node")
        found = found.select("node", F.least("above", "offer").alias("group"), (F.least("above", "offer") < F.col("group")).alias("changed"))
        found = stage(found, "groups")
        groups = found.select("node", "group")
        if found.filter("changed").isEmpty():
            return groups
