"""The inputs of the registered queries, each derived from the tables of one folder.

Tables that many queries read (landed files, the demand table, its history) are written once per
session and folder; everything else stays a lazy plan over the given tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.functions.timeparts import epoch_hours, epoch_micros
from kerbcast.models.regression import ablation, boosted
from kerbcast.operators import baselines, profile_states
from kerbcast.operators.cleaning import clean_trips
from kerbcast.operators.demand import with_filled_weather
from kerbcast.operators.drift import feature_baseline
from kerbcast.operators.lags import time_lags
from kerbcast.operators.residuals import mae, mape
from kerbcast.operators.splits import with_split, with_three_way_split
from kerbcast.plans import training
from kerbcast.plans.demand_build import build_demand
from kerbcast.schemas import COUNT, HOUR_TS, PICKUP
from kerbcast.session import fresh_path, written
from kerbcast.sources import readers, star_tables, writers

DRIFT_FEATURES = ["pickup_hour", "pickup_dow", "temperature_2m", "precipitation", "trip_count", "lag_24h"]

PROFILED = ["trip_distance", "fare_amount", "trip_duration", "extra"]
IDENTITIES = ["PULocationID", "DOLocationID", "trip_id"]

_OPEN: dict[tuple[str, str], "Tables"] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in _OPEN:
            _OPEN[key] = cls(spark, sf_dir)
        return _OPEN[key]

    def source(self, name: str) -> DataFrame:
        return star_tables.table(self.spark, self.sf_dir, name)

    @property
    def trips(self) -> DataFrame:
        return star_tables.trips_from_events(self.source("events"))

    @property
    def clean(self) -> DataFrame:
        return clean_trips(self.trips)

    @cached_property
    def trip_files(self) -> str:
        """Trips in monthly folders, every fiftieth row filed under the month after its own."""
        own = F.date_format(PICKUP, "yyyy-MM")
        following = F.date_format(F.add_months(F.to_date(PICKUP), 1), "yyyy-MM")
        label = F.when(F.col("trip_id") % 50 == 0, following).otherwise(own)
        path = fresh_path(self.spark, "raw-trips")
        writers.write_trip_months(self.trips.withColumn("label", label), path, "label")
        return path

    @cached_property
    def mixed_trip_files(self) -> str:
        """Trips by month whose files differ: even months have 32-bit zones and distances, a lower-case fee and times with a
        zone, odd ones lack the drop-off zone and the surcharge."""
        path = fresh_path(self.spark, "mixed-trips")
        labelled = self.trips.withColumn("label", F.date_format(PICKUP, "yyyy-MM"))
        even = F.month(PICKUP) % 2 == 0
        narrow = labelled.where(even).withColumns(
            {"PULocationID": F.col("PULocationID").cast("int"), "trip_distance": F.col("trip_distance").cast("float"),
             "tpep_pickup_datetime": F.col(PICKUP).cast("timestamp")}).withColumnRenamed("Airport_fee", "airport_fee")
        writers.write_trip_months(narrow, f"{path}/even", "label")
        wide = labelled.where(~even).withColumn("PULocationID", F.col("PULocationID").cast("long"))
        writers.write_trip_months(wide.drop("DOLocationID", "extra"), f"{path}/odd", "label")
        return path

    @cached_property
    def profile_store(self) -> str:
        """Profile states by month: those of the months before the newest one in one pass, then its own from its own files."""
        path, (year, month) = fresh_path(self.spark, "profile-states"), self.newest_month
        earlier = F.make_date("file_year", "file_month", F.lit(1)) < F.make_date(F.lit(year), F.lit(month), F.lit(1))
        for trips in (readers.load_clean_trips(self.spark, self.trip_files).where(earlier),
                      readers.load_clean_trips(self.spark, self.trip_files, year, month)):
            profile_states.store_states(profile_states.month_states(trips, PROFILED, IDENTITIES), path)
        return path

    @cached_property
    def newest_month(self) -> tuple[int, int]:
        """Year and month of the newest pickup."""
        last = self.trips.agg(F.max(PICKUP).alias("ts")).first()["ts"]
        return last.year, last.month

    @cached_property
    def weather_files(self) -> str:
        path = fresh_path(self.spark, "raw-weather")
        star_tables.raw_weather(self.trips).write.parquet(path)
        return path

    @cached_property
    def weather_json(self) -> str:
        """The weather as columnar JSON documents, one per month (at most 744 hours each)."""
        raw = self.spark.read.parquet(self.weather_files)
        columns = ["time", "temperature_2m", "precipitation", "snowfall"]
        docs = raw.groupBy(F.substring("time", 1, 7).alias("month")).agg(
            F.array_sort(F.collect_list(F.struct(*columns))).alias("h")
        )
        arrays = F.struct(*[F.col(f"h.{c}").alias(c) for c in columns])
        path = fresh_path(self.spark, "raw-weather-json")
        docs.select(F.to_json(F.struct(arrays.alias("hourly"))).alias("value")).write.text(path)
        return path

    @property
    def weather(self) -> DataFrame:
        return readers.read_weather(self.spark, self.weather_files)

    @cached_property
    def holidays(self) -> DataFrame:
        years = self.trips.select(F.year(PICKUP).alias("year")).distinct()
        return written(star_tables.holidays_of(years), "holidays")

    @cached_property
    def holiday_json(self) -> str:
        """Holidays of all order years as JSON arrays, one per year, with a field nobody reads."""
        years = self.source("orders").select(F.year("o_orderdate").alias("year")).distinct()
        rows = star_tables.holidays_of(years).withColumn("countryCode", F.lit("US"))
        docs = rows.groupBy(F.year("date").alias("y")).agg(
            F.to_json(F.collect_list(F.struct("date", "name", "countryCode"))).alias("value")
        )
        path = fresh_path(self.spark, "raw-holidays-json")
        docs.select("value").write.text(path)
        return path

    @cached_property
    def demand_files(self) -> str:
        path = fresh_path(self.spark, "demand")
        writers.write_demand(build_demand(self.clean, self.weather, self.holidays), path)
        return path

    @cached_property
    def demand(self) -> DataFrame:
        return readers.read_demand(self.spark, self.demand_files).drop("year")

    @cached_property
    def history(self) -> DataFrame:
        path = fresh_path(self.spark, "history")
        writers.append_history(self.demand, path)
        return writers.read_history(self.spark, path)

    @cached_property
    def lagged(self) -> DataFrame:
        """Demand with the counts 24 and 168 hours earlier, null where there are none."""
        return written(time_lags(self.split, self.demand, default=None), "lagged")

    @cached_property
    def drift_baseline(self) -> DataFrame:
        """The stored deciles of the training rows."""
        train = self.lagged.where(F.col("split") == "train")
        return written(feature_baseline(train, DRIFT_FEATURES), "feature-baseline")

    @cached_property
    def calibrated(self) -> DataFrame:
        """Calibration and test rows with the historical mean of the first 60 % of the time."""
        parts = with_three_way_split(self.demand)
        fitting, rest = (parts.where(f"split {op} 'train'") for op in ("=", "!="))
        return written(baselines.historical_mean(fitting, rest), "calibrated")

    @cached_property
    def model_rows(self) -> DataFrame:
        return written(with_split(training.model_rows(self.demand)), "model-rows")

    @cached_property
    def ablation(self) -> DataFrame:
        return written(ablation(self.model_rows, regressor=boosted()), "ablation")

    @property
    def filled(self) -> DataFrame:
        return with_filled_weather(self.demand)

    @cached_property
    def split(self) -> DataFrame:
        return written(with_split(self.demand), "split")

    @property
    def train(self) -> DataFrame:
        return self.split.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.split.where(F.col("split") == "test")

    @cached_property
    def scored(self) -> DataFrame:
        """Test rows with both baselines: ``prediction`` (historical mean) and ``naive``."""
        by_mean = baselines.historical_mean(self.train, self.test)
        return written(baselines.seasonal_naive(self.train, by_mean, name="naive"), "scored")

    @property
    def versions(self) -> DataFrame:
        """A model version per baseline and test day, with that day's errors."""
        models = [("demand_mean", 0, "prediction"), ("demand_naive", 1, "naive")]
        rows = F.array(*[
            F.struct(F.lit(n).alias("name"), F.lit(i).alias("k"), F.col(p).alias("p")) for n, i, p in models
        ])
        long = self.scored.select(F.to_date(HOUR_TS).alias("day"), COUNT, F.inline(rows))
        daily = long.groupBy("day", "name", "k").agg(
            F.bround(mae(prediction="p"), 2).alias("mae"), F.bround(mape(prediction="p"), 2).alias("mape")
        )
        start = F.col("day").cast("timestamp_ntz")
        return daily.select(
            (F.floor(epoch_hours(start) / 24).cast("long") * 10 + F.col("k")).alias("id"),
            start.alias("trained_at"), "name", "mae", "mape",
            F.lit(None).cast("int").alias("n_estimators"), F.lit(None).cast("double").alias("learning_rate"),
        )

    @property
    def served(self) -> DataFrame:
        """Logged predictions: each test row served by one of the day's two versions."""
        day = F.floor(epoch_micros(F.col(HOUR_TS)) / 86_400_000_000).cast("long")
        variant = (F.col("PULocationID") % 2).cast("int")
        return self.scored.select(
            F.col(HOUR_TS).alias("timestamp"), (day * 10 + variant).alias("model_version_id"),
            F.col("PULocationID").alias("zone_id"), F.col("pickup_hour").alias("hour"),
            F.col("pickup_dow").alias("day_of_week"), F.col("pickup_week").alias("week"),
            F.bround(F.when(variant == 1, F.col("naive")).otherwise(F.col("prediction")), 2)
            .alias("predicted_trips"),
        )

    @property
    def requests(self) -> DataFrame:
        return star_tables.requests_from_demand(self.demand)
