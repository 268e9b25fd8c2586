"""The zone-hour demand table and its enrichments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.city_events import at_city_event
from kerbcast.functions.timeparts import hour_floor
from kerbcast.schemas import AIRPORT_ZONES, COUNT, HOUR_TS, PICKUP, WEATHER, ZONE


def hourly_demand(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Trips per zone and hour. Rows are counted before the shuffle, so a busy zone does not skew it."""
    return (
        trips.where(F.col(ZONE).isNotNull())
        .groupBy(ZONE, hour_floor(F.col(ts)).alias(HOUR_TS))
        .agg(F.count(F.lit(1)).alias(COUNT))
    )


def with_calendar(df: DataFrame, ts: str = HOUR_TS, zone: str = ZONE) -> DataFrame:
    """Hour, weekday (Monday is 0), ISO week, weekend and airport flags."""
    return df.withColumns({
        "pickup_hour": F.hour(ts),
        "pickup_dow": F.weekday(ts),
        "pickup_week": F.weekofyear(ts),
        "pickup_is_weekend": F.weekday(ts) >= 5,
        "is_airport": F.col(zone).isin(AIRPORT_ZONES).cast("int"),
    })


def with_weather(demand: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join on the hour, which must not repeat in ``weather`` (``build_demand`` checks it). Hourly weather
    is small and is broadcast by its measured size."""
    return demand.join(weather.select(HOUR_TS, *WEATHER), HOUR_TS, "left")


def with_holiday(df: DataFrame, holidays: DataFrame, ts: str = HOUR_TS) -> DataFrame:
    """``is_holiday`` is 1 on the dates listed, else 0."""
    dates = holidays.select(F.col("date").alias("holiday_date")).distinct()
    return (
        df.join(dates, F.to_date(ts) == F.col("holiday_date"), "left")
        .withColumn("is_holiday", F.col("holiday_date").isNotNull().cast("int"))
        .drop("holiday_date")
    )


def with_city_event(df: DataFrame, ts: str = HOUR_TS, zone: str = ZONE) -> DataFrame:
    return df.withColumn("is_nyc_event", at_city_event(F.col(ts), F.col(zone)))


def with_listed_event(df: DataFrame, pairs: DataFrame, ts: str = HOUR_TS, zone: str = ZONE) -> DataFrame:
    """The same flag from a table of (event_date, zone_id) pairs, for calendars given as data."""
    keys = pairs.select(F.col("event_date"), F.col("zone_id").alias("event_zone")).distinct()
    here = (F.to_date(ts) == F.col("event_date")) & (F.col(zone) == F.col("event_zone"))
    return (
        df.join(keys, here, "left")
        .withColumn("is_nyc_event", F.col("event_zone").isNotNull().cast("int"))
        .drop("event_date", "event_zone")
    )


def with_filled_weather(df: DataFrame) -> DataFrame:
    """Missing weather, and a missing holiday flag, as 0."""
    columns = [c for c in [*WEATHER, "is_holiday"] if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast(df.schema[c].dataType) for c in columns})


def busiest_zones(demand: DataFrame, n: int | None = None) -> DataFrame:
    """Trips per zone, largest first, ties by zone id."""
    totals = demand.groupBy(ZONE).agg(F.sum(COUNT).alias("total_trips"))
    ordered = totals.orderBy(F.desc("total_trips"), ZONE)
    return ordered.limit(n) if n else ordered


def rows_of_busiest_zones(demand: DataFrame, n: int) -> DataFrame:
    return demand.join(busiest_zones(demand, n).select(ZONE), ZONE, "left_semi")
