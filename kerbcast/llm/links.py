"""Connected components of an edge table, by repeated neighbour minima and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``edges`` (``a``, ``b`` longs).

    Each round takes the smallest label among the neighbours, then the label of that label, so that chains
    shorten by halves; labels are written every round and only the number of changes reaches the driver.
    Repeated edges, loops and an empty table are allowed; edges with a null end are left out.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = stored(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("other")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other")))
        least = (labels.join(near, "node")
                 .select("node", F.col("component").alias("old"), F.least("component", "other").alias("at")))
        jumped = least.join(labels.select(F.col("node").alias("at"), F.col("component").alias("beyond")), "at").select(
            "node", F.least("at", "beyond").alias("component"), "old")
        labels = stored(jumped, "labels")
        if not labels.where("component <> old").limit(1).count():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
