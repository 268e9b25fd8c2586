"""Column names, feature lists and thresholds of the demand data model."""

from __future__ import annotations

ZONE = "PULocationID"
HOUR_TS = "pickup_hour_ts"
COUNT = "trip_count"
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# Identifiers and limits of the data model, needed for equal results.
MAX_ZONE = 265
AIRPORT_ZONES = [1, 132, 138]
MIN_DISTANCE, MAX_DISTANCE = 0.15, 40.0
MIN_FARE, MAX_FARE = 3.5, 150.0
CALENDAR_FEATURES = ["PULocationID", "pickup_hour", "pickup_dow", "pickup_week", "is_holiday"]
FULL_FEATURES = [
    "PULocationID", "pickup_hour", "pickup_dow", "pickup_week", "is_holiday",
    "snowfall", "lag_24h", "lag_168h", "is_airport", "is_nyc_event",
]
WEATHER = ["temperature_2m", "precipitation", "snowfall"]
SEQUENCE_FEATURES = [
    "trip_count", "pickup_hour", "pickup_dow", "temperature_2m", "precipitation", "snowfall",
]
ANOMALY_FEATURES = [
    "PULocationID", "pickup_hour", "pickup_dow", "trip_count",
    "temperature_2m", "precipitation", "snowfall", "is_holiday",
]
CLASSIFIER_FEATURES = [
    "PULocationID", "pickup_hour", "pickup_dow", "pickup_week",
    "temperature_2m", "precipitation", "snowfall", "is_holiday",
]
FARE_FEATURES = ["trip_distance", "Airport_fee", "extra", "trip_duration"]
FARE_TREE_FEATURES = FARE_FEATURES + ["PULocationID", "DOLocationID"]
TRIP_COLUMNS = [PICKUP, DROPOFF, ZONE, "trip_distance", "fare_amount"]
TRIP_EXTRAS = ["DOLocationID", "Airport_fee", "extra"]
MAE_LIMIT, MAPE_LIMIT = 7.0, 0.15
PSI_LIMIT = 0.2
OUTPUT_DRIFT_LIMIT = 0.10
HISTORY_COLUMNS = [
    "zone_id", HOUR_TS, COUNT, "pickup_hour", "pickup_dow", *WEATHER, "is_holiday",
]
# End of fixed values.
