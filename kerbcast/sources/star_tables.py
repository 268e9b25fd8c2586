"""Trips, weather, holidays and requests derived from the shared test tables.

``events`` becomes trips: times are shifted so that the city events of late October and November fall
inside, and zone, distance and surcharges follow from the event's own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.functions.timeparts import epoch_hours, hour_floor, nth_weekday
from kerbcast.schemas import DROPOFF, HOUR_TS, PICKUP, ZONE

TRIP_ZONES = [1, 132, 138, 161, 230, 68, 140, 236, 249, 79]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_from_events(events: DataFrame) -> DataFrame:
    zones = F.array(*[F.lit(z) for z in TRIP_ZONES])
    pickup = F.col("ts").cast("timestamp_ntz") + F.make_dt_interval(F.lit(303))
    surcharge = F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 4) / 2.0)
    return events.select(
        F.col("event_id").alias("trip_id"),
        pickup.alias(PICKUP),
        (pickup + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 90).cast("int"))).alias(DROPOFF),
        zones[(F.col("user_id") % 10).cast("int")].alias(ZONE),
        zones[(F.col("event_id") % 10).cast("int")].alias("DOLocationID"),
        F.col("value").alias("fare_amount"),
        (F.col("value") / 5.0 + (F.col("event_id") % 10) / 10.0).alias("trip_distance"),
        surcharge.alias("Airport_fee"),
        surcharge.alias("extra"),
    )


def raw_weather(trips: DataFrame) -> DataFrame:
    """One row per hour of the trips' range, ``time`` as text, some hours missing."""
    ends = trips.agg(F.min(PICKUP).alias("a"), F.max(PICKUP).alias("b"))
    hours = ends.select(F.explode(F.sequence(
        hour_floor(F.col("a")), hour_floor(F.col("b")), F.make_dt_interval(F.lit(0), F.lit(1))
    )).alias(HOUR_TS))
    h = F.col("h")
    return (
        hours.withColumn("h", epoch_hours(F.col(HOUR_TS))).where(h % 97 != 0)
        .select(
            F.date_format(HOUR_TS, "yyyy-MM-dd'T'HH:mm").alias("time"),
            ((h * 7 % 300) / 10.0 - 5).alias("temperature_2m"),
            F.when(h % 11 == 0, (h % 5) / 2.0).otherwise(0.0).alias("precipitation"),
            F.when(h % 17 == 0, (h % 7) / 1.0).otherwise(0.0).alias("snowfall"),
        )
    )


def holidays_of(years: DataFrame) -> DataFrame:
    """Veterans Day and Thanksgiving of every year in ``year``."""
    y = F.col("year")
    rows = F.array(
        F.struct(F.make_date(y, F.lit(11), F.lit(11)).alias("date"), F.lit("Veterans Day").alias("name")),
        F.struct(nth_weekday(y, 11, 3, 4).alias("date"), F.lit("Thanksgiving").alias("name")),
    )
    return years.select("year").distinct().select(F.inline(rows))


def requests_from_demand(demand: DataFrame) -> DataFrame:
    """A scoring request for every demand cell, one day later and some minutes into the hour."""
    minutes = F.make_dt_interval(F.lit(1), F.lit(0), (F.col(ZONE) % 60).cast("int"))
    return demand.select(
        F.col(ZONE).alias("zone_id"), (F.col(HOUR_TS) + minutes).alias("prediction_time")
    )
