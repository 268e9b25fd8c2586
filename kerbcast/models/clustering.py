"""Grouping zones by the shape of their day."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.operators.distribution import standardize
from kerbcast.operators.profiles import zone_profiles
from kerbcast.schemas import ZONE
from kerbcast.session import written

HOURS = [f"h{h}" for h in range(24)]


def zone_clusters(demand: DataFrame, k: int = 6, seed: int = 42, starts: int = 10) -> tuple[DataFrame, float]:
    """(zone_id, cluster) and the silhouette of the best of several starts.

    One row per zone remains after the profile; it is written once and all fits read that table.
    """
    scaled = written(standardize(zone_profiles(demand), HOURS), "zone-profiles")
    inputs = VectorAssembler(inputCols=[f"{h}_z" for h in HOURS], outputCol="features")
    points = inputs.transform(scaled).select(F.col(ZONE).alias("zone_id"), "features")
    models = [KMeans(k=k, seed=seed + i).fit(points) for i in range(starts)]
    best = min(models, key=lambda m: m.summary.trainingCost)
    assigned = best.transform(points)
    silhouette = ClusteringEvaluator().evaluate(assigned)
    return assigned.select("zone_id", F.col("prediction").alias("cluster")), silhouette


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_zones"), F.array_sort(F.collect_list("zone_id")).alias("zones")
    )
