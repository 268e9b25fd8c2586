"""Forecasts that need no fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.timeparts import plus_hours
from kerbcast.operators.splits import with_fold_segment
from kerbcast.schemas import COUNT, HOUR_TS, ZONE

PROFILE_KEYS = [ZONE, "pickup_hour", "pickup_dow"]


def _overall_mean(train: DataFrame):
    return train.agg(F.avg(COUNT).alias("mean")).scalar()


def seasonal_naive(train: DataFrame, points: DataFrame, hours: int = 168, name: str = "prediction") -> DataFrame:
    """The training count of the same zone exactly ``hours`` before, else the training mean."""
    past = train.select(
        F.col(ZONE).alias("_zone"), plus_hours(F.col(HOUR_TS), hours).alias("_ts"),
        F.col(COUNT).cast("double").alias("_seen"),
    )
    match = (F.col(ZONE) == F.col("_zone")) & (F.col(HOUR_TS) == F.col("_ts"))
    return (
        points.join(past, match, "left")
        .withColumn(name, F.coalesce("_seen", _overall_mean(train)))
        .drop("_zone", "_ts", "_seen")
    )


def historical_mean(train: DataFrame, points: DataFrame, name: str = "prediction") -> DataFrame:
    """The training mean of the same zone, hour and weekday, else the training mean."""
    means = train.groupBy(*PROFILE_KEYS).agg(F.avg(COUNT).alias("_mean"))
    return (
        points.join(means, PROFILE_KEYS, "left")
        .withColumn(name, F.coalesce("_mean", _overall_mean(train)))
        .drop("_mean")
    )


def _training_means(sums: DataFrame, keys: list[str], n_splits: int) -> DataFrame:
    """Mean per key over the segments before each test segment; null where there are none.

    ``sums`` holds one row per key and segment, so a key collects at most ``n_splits + 1`` entries.
    """
    folds = F.sequence(F.lit(0), F.lit(n_splits - 1))
    grown = (
        sums.groupBy(*keys).agg(F.collect_list(F.struct("segment", "s", "n")).alias("parts"))
        .select(*keys, "parts", F.explode(folds).alias("fold"))
    )
    seen = F.filter("parts", lambda p: p["segment"] <= F.col("fold"))

    def total(field: str):
        return F.aggregate(seen, F.lit(0).cast("long"), lambda acc, p: acc + p[field])

    return grown.select(
        *keys, (F.col("fold") + 1).alias("segment"),
        F.try_divide(total("s"), total("n")).alias("mean"),
    )


def fold_historical_mean(demand: DataFrame, n_splits: int = 5) -> DataFrame:
    """Out-of-fold historical means for every expanding-window fold at once.

    Sums per key and time segment are accumulated over the segments, which gives the training mean of
    every fold without copying rows into folds.
    """
    parts = with_fold_segment(demand, n_splits)
    sums = parts.groupBy(*PROFILE_KEYS, "segment").agg(
        F.sum(COUNT).alias("s"), F.count(F.lit(1)).alias("n")
    )
    key_means = _training_means(sums, PROFILE_KEYS, n_splits).withColumnRenamed("mean", "_mean")
    overall = _training_means(
        sums.groupBy("segment").agg(F.sum("s").alias("s"), F.sum("n").alias("n")), [], n_splits
    ).withColumnRenamed("mean", "_overall").where(F.col("_overall").isNotNull())
    # `overall` has one row per fold.
    return (
        parts.join(key_means, [*PROFILE_KEYS, "segment"], "left")
        .join(F.broadcast(overall), "segment")
        .withColumn("prediction", F.coalesce("_mean", "_overall"))
        .withColumn("fold", F.col("segment") - 1)
        .drop("_mean", "_overall", "segment")
    )
