"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from iterweave.workspace import Workspace


def connected_components(ws: Workspace, links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link (a, b): the smallest node reachable.

    Each round a node takes the smallest label among its own, its neighbours' and that of
    the node its label names; label chains halve, so rounds grow with the logarithm of the
    diameter.  Every round is a written table; only its count of changes comes back.
    """
    both = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct()
    both = ws.materialize(both, "links").df
    start = both.groupBy("node").agg(F.min("other").alias("seen"))
    labels = ws.materialize(
        start.select("node", F.least("node", "seen").alias("component")), "labels"
    )
    while True:
        now = labels.df
        heard = (
            both.join(now.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("heard"))
        )
        named = now.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        step = (
            now.join(heard, "node")
            .join(named, "component")
            .select(
                "node",
                F.least("component", "heard", "jump").alias("component"),
                (F.least("heard", "jump") < F.col("component")).cast("int").alias("changed"),
            )
        )
        following = ws.materialize(step, "labels", changed=F.sum("changed"))
        ws.discard(labels)
        labels = following
        if not following.metrics["changed"]:
            return following.df.select("node", "component")
