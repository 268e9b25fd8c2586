"""Batch scoring of prediction requests, and the monthly monitoring step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.functions.timeparts import hour_floor
from kerbcast.models.regression import predict
from kerbcast.models.sequence import score_sequences
from kerbcast.operators.abtest import clipped, route
from kerbcast.operators.demand import (
    with_calendar, with_city_event, with_filled_weather, with_holiday,
)
from kerbcast.operators.drift import (
    drifted_features, feature_psi, output_drift, retrain_decision,
)
from kerbcast.operators.lags import latest_history, time_lags
from kerbcast.operators.residuals import forecast_errors
from kerbcast.plans.demand_build import build_demand
from kerbcast.schemas import FULL_FEATURES, HOUR_TS, SEQUENCE_FEATURES, ZONE
from kerbcast.session import written
from kerbcast.sources.readers import load_clean_trips


def dated(requests: DataFrame) -> DataFrame:
    """Requests with zone, floored hour and calendar columns."""
    return with_calendar(
        requests.withColumn(HOUR_TS, hour_floor(F.col("prediction_time"))).withColumn(ZONE, F.col("zone_id")))


def request_features(
    requests: DataFrame, history: DataFrame, weather: DataFrame, holidays: DataFrame
) -> DataFrame:
    """Model features of (zone_id, prediction_time) requests.

    The time is floored to the hour before any lookup. Unknown lags and snowfall are 0.
    """
    marked = with_city_event(with_holiday(dated(requests), holidays))
    snow = weather.select(HOUR_TS, F.col("snowfall").alias("_snow"))
    snowy = marked.join(snow, HOUR_TS, "left").withColumn(
        "snowfall", F.coalesce("_snow", F.lit(0.0))
    ).drop("_snow")
    return time_lags(snowy, history, history_zone="zone_id")


def _bounded(prediction: Column, margin: Column) -> dict[str, Column]:
    return {
        "lower_bound": F.bround(clipped(prediction - margin), 2),
        "upper_bound": F.bround(prediction + margin, 2),
    }


def score_requests(features: DataFrame, model: Model, margin: Column) -> DataFrame:
    """Clipped and rounded predictions with conformal bounds."""
    scored = predict(model, features, "_raw").withColumn(
        "predicted_trips", F.bround(clipped(F.col("_raw")), 2)
    )
    return scored.withColumns(_bounded(F.col("predicted_trips"), margin)).drop("_raw")


def score_with_history(requests: DataFrame, history: DataFrame, sequence_model, window: int = 24) -> DataFrame:
    """Predictions from each zone's newest rows; ``error`` where a zone has too few of them.

    The model is applied once per zone, not once per request; predictions join by their measured size.
    """
    last = latest_history(history, window)
    zones = last.groupBy("zone_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("step", F.struct(*SEQUENCE_FEATURES).alias("h")))),
            lambda s: s["h"],
        ).alias("history")
    )
    by_zone = score_sequences(sequence_model, zones).select(
        "zone_id", F.bround("prediction", 2).alias("predicted_trips")
    )
    missing = F.concat(F.lit("not enough history for zone "), F.col("zone_id").cast("string"))
    return requests.join(by_zone, "zone_id", "left").withColumn(
        "error", F.when(F.col("predicted_trips").isNull(), missing)
    )


def score_both(
    requests: DataFrame, history: DataFrame, weather: DataFrame, holidays: DataFrame, model: Model, margin: Column,
    sequence_model, share_b: float = 0.5,
) -> DataFrame:
    """Requests routed between the feature model (A) and the sequence model (B). They are routed first, so that
    features are only looked up for those that need them."""
    routed = route(requests, "zone_id", "prediction_time", share_b=share_b)
    features = request_features(routed.where(F.col("variant") == "A"), history, weather, holidays)
    keep = ["zone_id", "prediction_time", "pickup_hour", "pickup_dow", "pickup_week", "variant"]
    a = score_requests(features, model, margin)
    b = score_with_history(dated(routed.where(F.col("variant") == "B")).select(*keep), history, sequence_model)
    return a.select(*keep, "predicted_trips", "lower_bound", "upper_bound").unionByName(
        b.select(*keep, "predicted_trips", "error"), allowMissingColumns=True
    )


def prediction_log(scored: DataFrame, versions: dict[str, int]) -> DataFrame:
    """Served predictions as rows of the predictions table."""
    version = F.create_map(*[x for k, v in versions.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    return scored.where(F.col("predicted_trips").isNotNull()).select(
        F.col("prediction_time").alias("timestamp"),
        F.element_at(version, F.col("variant")).alias("model_version_id"),
        "zone_id", F.col("pickup_hour").alias("hour"), F.col("pickup_dow").alias("day_of_week"),
        F.col("pickup_week").alias("week"), "predicted_trips",
    )


def monitor(
    scored: DataFrame, baseline: DataFrame, versions: DataFrame, name: str, features: Sequence[str]
) -> DataFrame:
    """One row: errors of the scored month, drift and whether to retrain. Takes no action itself."""
    errors = forecast_errors(scored)
    current = errors.select(F.lit(name).alias("name"), F.col("mae").alias("current_mae"))
    drifted = output_drift(versions.where(F.col("name") == name), current).agg(
        F.coalesce(F.max("drifted"), F.lit(False)).alias("d")
    )
    inputs = drifted_features(feature_psi(scored, baseline, features)).agg(
        F.array_sort(F.collect_list("feature")).alias("f")
    )
    return retrain_decision(
        errors.withColumns({"output_drifted": drifted.scalar(), "drifted_features": inputs.scalar()})
    )


def monitor_month(
    spark: SparkSession, trip_files: str, year: int, month: int, weather: DataFrame, holidays: DataFrame,
    history: DataFrame, model: Model, baseline: DataFrame, versions: DataFrame, name: str,
    features: Sequence[str] = tuple(FULL_FEATURES),
) -> DataFrame:
    """Build the demand of one month from its files, score it and decide. Lags come from the history."""
    trips = load_clean_trips(spark, trip_files, year, month)
    demand = build_demand(trips, weather, holidays, validate=True)
    rows = with_filled_weather(time_lags(demand, history, history_zone="zone_id"))
    scored = written(predict(model, rows), "scored-month")
    return monitor(scored, baseline, versions, name, features)
