"""Registered queries: one per operator, each over whole tables.

Results are brought to common types (64-bit integers, doubles rounded to six digits) so that they can
be compared with another engine's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbcast.functions.city_events import event_calendar
from kerbcast.models import anomaly, classifier, clustering, contributions, importance, regression, sequence
from kerbcast.operators import (
    abtest, baselines, cleaning, demand, distribution, drift, information, intervals, lags, profile_states, profiles,
    residuals, splits, training_rows, validation,
)
from kerbcast.plans import scoring, training
from kerbcast.plans.demand_build import build_demand
from kerbcast.plans.tables import DRIFT_FEATURES, Tables
from kerbcast.schemas import (
    ANOMALY_FEATURES, CALENDAR_FEATURES, COUNT, FARE_FEATURES, FULL_FEATURES,
    HOUR_TS, PICKUP, WEATHER, ZONE,
)
from kerbcast.session import fresh_path, written
from kerbcast.sources import readers, writers
from kerbcast.streaming import hourly

Query = Callable[[Tables], DataFrame]
REGISTRY: dict[str, Query] = {}
CELL = [ZONE, HOUR_TS]


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def tidy(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


def runner(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: tidy(fn(Tables.of(spark, sf_dir)))


# --- sources and sinks -----------------------------------------------------------------------------

@query
def scan_trips(t: Tables) -> DataFrame:
    loaded = readers.load_clean_trips(t.spark, t.trip_files)
    return loaded.groupBy("file_year", "file_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fare_amount").alias("fares"),
        F.sum("trip_duration").alias("minutes"), F.sum("extra").alias("extras"),
    )


@query
def scan_mixed_schemas(t: Tables) -> DataFrame:
    """Months of different types, spelling and columns, read as one table."""
    loaded = readers.load_clean_trips(t.spark, t.mixed_trip_files)
    return loaded.groupBy("file_year", "file_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fare_amount").alias("fares"), F.sum("Airport_fee").alias("fees"),
        F.sum("extra").alias("extras"), F.count("DOLocationID").alias("known_ends"), F.sum(ZONE).alias("zones"),
        F.min(PICKUP).alias("first_pickup"),
    )


@query
def scan_one_month(t: Tables) -> DataFrame:
    loaded = readers.load_clean_trips(t.spark, t.trip_files, *t.newest_month)
    return loaded.select("trip_id", PICKUP, "trip_duration", "Airport_fee")


@query
def weather_hourly(t: Tables) -> DataFrame:
    return readers.read_weather(t.spark, t.weather_files)


@query
def weather_from_json(t: Tables) -> DataFrame:
    return readers.read_weather_json(t.spark, t.weather_json, multi_line=False)


@query
def holiday_dates(t: Tables) -> DataFrame:
    return readers.holiday_dates(readers.read_holidays_json(t.spark, t.holiday_json, multi_line=False))


@query
def demand_roundtrip(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "roundtrip")
    writers.write_demand(build_demand(t.clean, t.weather, t.holidays), path)
    return readers.read_demand(t.spark, path)


@query
def history_insert_if_absent(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "history")
    airports = t.demand.where(F.col("is_airport") == 1)
    writers.append_history(airports.withColumn(COUNT, F.col(COUNT) + 1000), path)
    writers.append_history(t.demand, path)
    writers.append_history(t.demand, path)
    return writers.read_history(t.spark, path)


@query
def predictions_append(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "predictions")
    for variant in (0, 1):
        writers.append_rows(t.served.where(F.col("model_version_id") % 10 == variant), path)
    return t.spark.read.parquet(path)


@query
def model_version_append(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "versions")
    for name in ("demand_mean", "demand_naive"):
        writers.append_rows(t.versions.where(F.col("name") == name), path)
    return t.spark.read.parquet(path).select("id", "trained_at", "name", "mae", "mape")


@query
def file_completeness(t: Tables) -> DataFrame:
    return readers.file_completeness(readers.read_trips(t.spark, t.trip_files))


@query
def run_log(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "runs")
    compared = residuals.compare_predictions(t.scored, {"historical_mean": "prediction", "seasonal_naive": "naive"})
    rows = writers.run_rows(
        compared, "demand", baselines.PROFILE_KEYS, {"learning_rate": 0.05}, {"source": "batch"}, "model"
    )
    writers.append_rows(rows, path)
    stored = t.spark.read.schema(writers.RUN_SCHEMA).parquet(path)
    return writers.search_runs(stored).join(
        stored.select("run_name", F.col("params")["features"].alias("features"),
                      F.col("metrics")["mape"].alias("mape"), F.col("tags")["source"].alias("source")),
        "run_name",
    )


# --- rows ------------------------------------------------------------------------------------------

@query
def clean_trips(t: Tables) -> DataFrame:
    return t.clean


@query
def trip_duration(t: Tables) -> DataFrame:
    return cleaning.with_trip_duration(t.trips).select("trip_id", "trip_duration")


@query
def demand_hourly(t: Tables) -> DataFrame:
    return demand.hourly_demand(t.clean)


@query
def calendar_features(t: Tables) -> DataFrame:
    return demand.with_calendar(demand.hourly_demand(t.clean))


@query
def order_calendar(t: Tables) -> DataFrame:
    orders = t.source("orders").select("o_orderkey", F.lit(132).alias(ZONE), "o_orderdate")
    return demand.with_calendar(orders, "o_orderdate")


@query
def drop_incomplete(t: Tables) -> DataFrame:
    return cleaning.drop_incomplete(t.demand, ANOMALY_FEATURES).select(*CELL, *WEATHER)


@query
def min_trips(t: Tables) -> DataFrame:
    return cleaning.more_trips_than(t.demand, 1).select(*CELL, COUNT)


@query
def latest_year(t: Tables) -> DataFrame:
    return cleaning.latest_year(t.source("orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query
def validate_trips(t: Tables) -> DataFrame:
    return validation.failure_counts(t.trips, validation.TRIP_RULES)


def _damaged(t: Tables) -> DataFrame:
    """Demand with values moved out of range, so that the rules have something to find."""
    return t.demand.withColumns({
        ZONE: F.col(ZONE) * 2, COUNT: F.col(COUNT) - 2, "pickup_dow": F.col("pickup_dow") + 1,
        "pickup_week": F.when(F.col("pickup_hour") != 13, F.col("pickup_week")),
        "precipitation": F.col("precipitation") - 1, "is_holiday": F.col("is_holiday") * 2,
    })


@query
def validate_demand(t: Tables) -> DataFrame:
    return validation.failure_counts(_damaged(t), validation.DEMAND_RULES)


@query
def validation_failures(t: Tables) -> DataFrame:
    return validation.failures(_damaged(t), validation.DEMAND_RULES, [HOUR_TS])


@query
def validate_requests(t: Tables) -> DataFrame:
    requests = t.demand.select(
        F.col(ZONE).alias("zone_id"), (F.col("pickup_hour") + F.col("pickup_dow")).alias("hour"),
        F.col("pickup_dow").alias("day_of_week"), (F.col("pickup_week") + 5).alias("week"), "is_holiday",
        (F.col("snowfall") - 1).alias("snowfall"),
        F.when(F.col(COUNT) > 1, F.col(COUNT)).alias("lag_24h"), F.lit(0.0).alias("lag_168h"), "is_nyc_event",
    )
    marked = validation.with_outcome(validation.with_request_defaults(requests), validation.REQUEST_RULES)
    return marked.groupBy("zone_id", "outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("lag_24h").alias("lags"))


@query
def feature_matrix(t: Tables) -> DataFrame:
    return validation.feature_matrix(training.model_rows(t.demand), FULL_FEATURES, COUNT)


@query
def weather_filled(t: Tables) -> DataFrame:
    return t.filled.select(*CELL, *WEATHER, "is_holiday")


@query
def snow_buckets(t: Tables) -> DataFrame:
    return profiles.with_snow_bucket(t.demand).select(*CELL, "snow_bucket")


@query
def demand_bands(t: Tables) -> DataFrame:
    fine = residuals.with_demand_band(t.demand)
    return fine.withColumn(
        "coarse_band",
        residuals.cut(F.col(COUNT), residuals.COARSE_BAND_EDGES, residuals.COARSE_BAND_LABELS),
    ).select(*CELL, "demand_band", "coarse_band")


def _positive(t: Tables) -> DataFrame:
    return t.trips.where((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0))


# Caps and floors whose shares are reported, and the fare histogram's range and bins.
FARE_CAPS, FARE_FLOORS = [50, 100, 150, 200], [0.5 * i for i in range(1, 10)]
DISTANCE_FLOORS = [0.05, 0.1, 0.15, 0.2, 0.25]
FARE_RANGE, FARE_BINS = (0.01, 200), 33
# End of fixed values.


@query
def threshold_shares(t: Tables) -> DataFrame:
    return cleaning.threshold_shares(_positive(t), {
        "fare_amount": (FARE_CAPS, FARE_FLOORS), "trip_distance": ([], DISTANCE_FLOORS),
    })


@query
def iqr_bounds(t: Tables) -> DataFrame:
    return cleaning.iqr_bounds(_positive(t), "fare_amount")


@query
def out_of_month(t: Tables) -> DataFrame:
    loaded = readers.read_trips(t.spark, t.trip_files)
    return cleaning.outside_file_month(loaded).select("trip_id", PICKUP, "file_year", "file_month")


@query
def high_demand_label(t: Tables) -> DataFrame:
    return training_rows.with_high_demand(t.demand).select(*CELL, COUNT, "high_demand")


@query
def ab_route(t: Tables) -> DataFrame:
    return abtest.route(t.requests, "zone_id", "prediction_time")


@query
def hash_sample(t: Tables) -> DataFrame:
    return cleaning.sample_share(t.clean, 0.1, ["trip_id"]).select("trip_id", "fare_amount")


@query
def hash_sample_rows(t: Tables) -> DataFrame:
    return cleaning.sample_rows(t.clean, 500, ["trip_id"]).select("trip_id")


# --- joins -----------------------------------------------------------------------------------------

@query
def demand_with_weather(t: Tables) -> DataFrame:
    return demand.with_weather(demand.hourly_demand(t.clean), t.weather)


@query
def demand_with_holiday(t: Tables) -> DataFrame:
    return demand.with_holiday(demand.hourly_demand(t.clean), t.holidays)


@query
def demand_with_city_event(t: Tables) -> DataFrame:
    return demand.with_city_event(demand.hourly_demand(t.clean))


@query
def demand_with_listed_event(t: Tables) -> DataFrame:
    cells = demand.hourly_demand(t.clean)
    return demand.with_listed_event(cells, event_calendar(cells.select(F.year(HOUR_TS).alias("year"))))


@query
def city_event_calendar(t: Tables) -> DataFrame:
    years = t.source("orders").select(F.year("o_orderdate").alias("year"))
    return event_calendar(years.union(t.trips.select(F.year(PICKUP).alias("year"))))


@query
def demand_table(t: Tables) -> DataFrame:
    return build_demand(t.clean, t.weather, t.holidays, validate=True)


@query
def seasonal_naive(t: Tables) -> DataFrame:
    return baselines.seasonal_naive(t.train, t.test).select(*CELL, COUNT, "prediction")


@query
def historical_mean(t: Tables) -> DataFrame:
    return baselines.historical_mean(t.train, t.test).select(*CELL, COUNT, "prediction")


@query
def lag_by_time(t: Tables) -> DataFrame:
    return lags.time_lags(t.demand, t.demand).select(*CELL, "lag_24h", "lag_168h")


@query
def lag_by_rows(t: Tables) -> DataFrame:
    return lags.row_lags(t.demand).select(*CELL, "lag_24h", "lag_168h")


@query
def ab_results(t: Tables) -> DataFrame:
    return abtest.version_usage(t.versions, t.served).select(
        "id", "name", "trained_at", "mae", "mape", "prediction_count"
    )


@query
def top_zone_rows(t: Tables) -> DataFrame:
    return demand.rows_of_busiest_zones(t.demand, 4).select(*CELL, COUNT)


@query
def ab_pairs(t: Tables) -> DataFrame:
    pairs = training.paired_points(t.demand)
    recent = F.aggregate("history", F.lit(0.0), lambda a, h: a + h[COUNT]) / F.size("history")
    return pairs.select(*CELL, "target", "lag_24h", "lag_168h", recent.alias("history_mean"))


# --- aggregates ------------------------------------------------------------------------------------

@query
def demand_by_hour_dow(t: Tables) -> DataFrame:
    return profiles.trips_by_zone_hour_dow(t.clean)


@query
def busy_cell_share(t: Tables) -> DataFrame:
    return profiles.share_at_least(profiles.trips_by_zone_hour_dow(t.clean))


@query
def cells_by_hour(t: Tables) -> DataFrame:
    return profiles.cells_by_hour(profiles.trips_by_zone_hour_dow(t.clean))


@query
def trips_by_hour(t: Tables) -> DataFrame:
    return profiles.trips_by_hour(t.clean)


@query
def trips_by_dow(t: Tables) -> DataFrame:
    return profiles.trips_by_dow(t.clean)


@query
def trips_dow_hour_pivot(t: Tables) -> DataFrame:
    return profiles.trips_dow_hour(t.clean)


@query
def zone_profiles(t: Tables) -> DataFrame:
    return profiles.zone_profiles(t.demand)


@query
def dow_hour_profile(t: Tables) -> DataFrame:
    return profiles.dow_hour_means(t.demand)


@query
def hour_profile(t: Tables) -> DataFrame:
    return profiles.hour_means_of_dows(t.demand)


@query
def peak_trough(t: Tables) -> DataFrame:
    return profiles.peak_trough(t.demand)


@query
def zone_concentration(t: Tables) -> DataFrame:
    return profiles.zone_concentration(t.demand, (3, 5))


@query
def lorenz_curve(t: Tables) -> DataFrame:
    return profiles.zone_shares(t.demand)


@query
def snow_effect(t: Tables) -> DataFrame:
    return profiles.snow_effect(t.demand)


@query
def holiday_effect(t: Tables) -> DataFrame:
    return profiles.holiday_effect(t.demand)


@query
def holiday_by_hour(t: Tables) -> DataFrame:
    return profiles.holiday_by_hour(t.demand)


@query
def describe_trip_count(t: Tables) -> DataFrame:
    return distribution.describe(t.demand, [COUNT, *WEATHER])


@query
def describe_trips(t: Tables) -> DataFrame:
    return distribution.describe(t.clean, ["trip_distance", "fare_amount", "trip_duration"], coarse_first=True)


@query
def distribution_shape(t: Tables) -> DataFrame:
    return distribution.shape(t.demand, COUNT)


@query
def histogram_trip_count(t: Tables) -> DataFrame:
    return distribution.histogram(t.demand, F.col(COUNT))


@query
def histogram_log_trip_count(t: Tables) -> DataFrame:
    return distribution.histogram(t.demand, F.log1p(COUNT))


@query
def histogram_fares(t: Tables) -> DataFrame:
    return distribution.histogram(_positive(t).where(F.col("fare_amount").between(*FARE_RANGE)), F.col("fare_amount"), FARE_BINS)


@query
def ecdf_trip_count(t: Tables) -> DataFrame:
    return distribution.ecdf(t.demand, COUNT)


@query
def ecdf_fares(t: Tables) -> DataFrame:
    return distribution.ecdf(t.clean, "fare_amount")


NUMERIC = ["trip_count", "pickup_hour", "pickup_dow", "pickup_week", "is_airport", *WEATHER, "is_holiday", "is_nyc_event"]


@query
def feature_correlations(t: Tables) -> DataFrame:
    return distribution.correlation_matrix(t.demand, NUMERIC)


@query
def target_correlations(t: Tables) -> DataFrame:
    return distribution.correlation_with(t.demand, COUNT, [c for c in NUMERIC if c != COUNT])


@query
def profile_trips(t: Tables) -> DataFrame:
    return distribution.profile(t.trips, PICKUP, [ZONE, "DOLocationID"], ["Airport_fee", "extra", "fare_amount"])


@query
def profile_merged(t: Tables) -> DataFrame:
    """Moments of all months from the stored states; no trip is read again."""
    return profile_states.moments(profile_states.read_states(t.spark, t.profile_store))


@query
def profile_sketched(t: Tables) -> DataFrame:
    """Quartiles and distinct counts of all months from the stored sketches, with their stated error."""
    return profile_states.sketched(profile_states.read_states(t.spark, t.profile_store))


@query
def profile_drift(t: Tables) -> DataFrame:
    """PSI of every stored month against the first one, from states alone."""
    states = profile_states.read_states(t.spark, t.profile_store)
    month = F.make_date("file_year", "file_month", F.lit(1))
    first = states.agg(F.min(month)).scalar()
    return profile_states.state_psi(states.where(month == first), states, *profile_states.MONTH)


@query
def null_counts(t: Tables) -> DataFrame:
    return distribution.null_counts(t.demand)


@query
def demand_years(t: Tables) -> DataFrame:
    return t.demand.select(F.year(HOUR_TS).alias("year")).distinct()


@query
def forecast_errors(t: Tables) -> DataFrame:
    return residuals.forecast_errors(t.scored)


@query
def forecast_errors_zero_safe(t: Tables) -> DataFrame:
    return residuals.zero_safe_errors(t.scored.withColumn(COUNT, F.col(COUNT) - 1))


@query
def baseline_comparison(t: Tables) -> DataFrame:
    return residuals.compare_predictions(t.scored, {"historical_mean": "prediction", "seasonal_naive": "naive"})


@query
def residual_summary(t: Tables) -> DataFrame:
    return residuals.residual_summary(t.scored)


@query
def error_by_band(t: Tables) -> DataFrame:
    return residuals.error_by_band(t.scored)


@query
def error_by_zone(t: Tables) -> DataFrame:
    return residuals.error_by_zone(t.scored)


@query
def error_by_hour(t: Tables) -> DataFrame:
    return residuals.error_by_hour(t.scored)


@query
def worst_hours(t: Tables) -> DataFrame:
    return residuals.worst_hours(t.scored)


@query
def error_by_week(t: Tables) -> DataFrame:
    return residuals.error_by_week(t.scored)


@query
def weekly_stability(t: Tables) -> DataFrame:
    return residuals.weekly_stability(t.scored)


@query
def bias_by_quintile(t: Tables) -> DataFrame:
    return residuals.bias_by_quintile(t.scored)


@query
def airport_errors(t: Tables) -> DataFrame:
    return residuals.error_by(t.scored, "is_airport")


@query
def cv_baseline_mae(t: Tables) -> DataFrame:
    return residuals.cv_errors(baselines.fold_historical_mean(t.demand))


@query
def cv_summary(t: Tables) -> DataFrame:
    summary = residuals.cv_summary(residuals.cv_errors(baselines.fold_historical_mean(t.demand)))
    text = F.concat_ws(",", F.transform("folds", lambda x: F.format_string("%.3f", x)))
    return summary.withColumn("folds", text)


@query
def ab_ttest_stats(t: Tables) -> DataFrame:
    return abtest.paired_moments(abtest.paired_errors(t.scored, "prediction", "naive"))


@query
def ab_ttest(t: Tables) -> DataFrame:
    return abtest.paired_t_test(abtest.paired_errors(t.scored, "prediction", "naive"), ("mean", "naive"))


@query
def ab_compare(t: Tables) -> DataFrame:
    pairs = training.paired_points(t.demand).withColumnRenamed("target", COUNT)
    return abtest.paired_moments(abtest.paired_errors(pairs, "lag_24h", "lag_168h"))


@query
def ab_power(t: Tables) -> DataFrame:
    errors = t.scored.withColumns(residuals.error_columns())
    return abtest.power_analysis(errors)


@query
def ab_power_exact(t: Tables) -> DataFrame:
    return abtest.exact_power_analysis(t.scored.withColumns(residuals.error_columns()))


@query
def label_rates(t: Tables) -> DataFrame:
    return training_rows.label_rates(classifier.prepare(t.demand))


@query
def dispatch_simulation(t: Tables) -> DataFrame:
    return intervals.dispatch_simulation(t.scored, {"historical_mean": "prediction", "seasonal_naive": "naive"})


# --- history and order -----------------------------------------------------------------------------

@query
def autocorrelation(t: Tables) -> DataFrame:
    return lags.autocorrelation(t.demand)


@query
def autocorrelation_every_zone(t: Tables) -> DataFrame:
    return lags.autocorrelation(t.demand, (1, 24, 168), every_zone=True)


@query
def autocorrelation_function(t: Tables) -> DataFrame:
    return lags.autocorrelation(t.demand, range(1, 200))


@query
def sequence_windows(t: Tables) -> DataFrame:
    windows = lags.sequence_windows(t.demand)
    total = F.aggregate("history", F.lit(0).cast("long"), lambda a, h: a + h[COUNT])
    return windows.select(
        *CELL, "target", "split", F.size("history").alias("steps"), total.alias("history_trips"),
        F.col("history")[0][COUNT].alias("oldest"), F.col("history")[23][COUNT].alias("newest"),
    )


@query
def last_24_history(t: Tables) -> DataFrame:
    return lags.latest_history(t.history).select("zone_id", HOUR_TS, COUNT, "step")


@query
def short_histories(t: Tables) -> DataFrame:
    return lags.zones_short_of_history(t.history, 600)


@query
def latest_model_version(t: Tables) -> DataFrame:
    return abtest.latest_versions(t.versions).select("id", "name", "trained_at", "mae", "mape")


@query
def top_zones(t: Tables) -> DataFrame:
    return demand.busiest_zones(t.demand, 5)


@query
def worst_zones(t: Tables) -> DataFrame:
    return residuals.worst_zones(t.scored, 5)


@query
def recent_models(t: Tables) -> DataFrame:
    return abtest.newest(t.versions, 20, "trained_at", "name").select("id", "name", "trained_at", "mae", "mape")


@query
def recent_history(t: Tables) -> DataFrame:
    return drift.recent_inputs(t.history)


# --- splits, weights, intervals --------------------------------------------------------------------

@query
def time_split(t: Tables) -> DataFrame:
    return splits.with_split(t.demand).select(*CELL, "split")


@query
def trip_time_split(t: Tables) -> DataFrame:
    return splits.with_split(t.clean, PICKUP).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min(PICKUP).alias("first_ts"), F.max(PICKUP).alias("last_ts")
    )


@query
def three_way_split(t: Tables) -> DataFrame:
    return splits.with_three_way_split(t.demand).select(*CELL, "split")


@query
def cv_folds(t: Tables) -> DataFrame:
    return splits.fold_sizes(t.demand)


@query
def sample_weights(t: Tables) -> DataFrame:
    return training_rows.with_sample_weight(t.train).select(*CELL, "sample_weight")


@query
def standardize(t: Tables) -> DataFrame:
    columns = ["pickup_hour", "trip_count", "is_holiday"]
    return distribution.standardize(t.demand, columns, t.train).select(*CELL, *[f"{c}_z" for c in columns])


def _conformal(t: Tables) -> tuple[DataFrame, DataFrame]:
    part = F.col("split")
    return t.calibrated.where(part == "calibration"), t.calibrated.where(part == "test")


@query
def conformal_bounds(t: Tables) -> DataFrame:
    calibration, _ = _conformal(t)
    plain = intervals.conformal_margins(calibration)
    logged = intervals.conformal_margins(calibration, log_scale=True)
    return plain.withColumn("scale", F.lit("linear")).unionByName(logged.withColumn("scale", F.lit("log")))


@query
def interval_coverage(t: Tables) -> DataFrame:
    calibration, test = _conformal(t)
    margins = written(intervals.conformal_margins(calibration, log_scale=True), "margins")
    out = [
        intervals.interval_quality(
            intervals.with_interval(test, intervals.margin_for(margins, c), log_scale=True)
        ).withColumn("target", F.lit(c))
        for c in (0.8, 0.95)
    ]
    return out[0].unionByName(out[1])


@query
def classification_metrics(t: Tables) -> DataFrame:
    labelled = training_rows.with_high_demand(t.scored)
    return training_rows.ranking_metrics(labelled, "high_demand", "prediction")


@query
def classification_report(t: Tables) -> DataFrame:
    labelled = training_rows.with_high_demand(t.scored).withColumn(
        "predicted", (F.col("prediction") >= 2).cast("int")
    )
    return training_rows.class_report(labelled, "high_demand", "predicted")


@query
def mutual_information(t: Tables) -> DataFrame:
    return distribution.mutual_information(t.demand, [*CALENDAR_FEATURES, *WEATHER], COUNT)


@query
def neighbour_information(t: Tables) -> DataFrame:
    return information.neighbour_information(t.demand, [*CALENDAR_FEATURES, *WEATHER], COUNT, CELL)


# --- drift -----------------------------------------------------------------------------------------

@query
def feature_baseline(t: Tables) -> DataFrame:
    train = t.lagged.where(F.col("split") == "train")
    found = drift.feature_baseline(train, [*DRIFT_FEATURES, ZONE], {ZONE})
    return found.select("feature", "n", F.posexplode("breakpoints").alias("decile", "breakpoint"))


@query
def feature_psi(t: Tables) -> DataFrame:
    return drift.feature_psi(t.lagged.where(F.col("split") == "test"), t.drift_baseline, DRIFT_FEATURES)


@query
def drifted_features(t: Tables) -> DataFrame:
    return drift.drifted_features(feature_psi(t), 0.2)


@query
def recent_drift(t: Tables) -> DataFrame:
    report = drift.drift_report(t.history, t.drift_baseline)
    return report.select(
        "rows_analyzed", F.size("features_checked").alias("n_checked"),
        F.concat_ws(",", "drifted_features").alias("drifted"), "baseline_exists",
    )


@query
def output_drift(t: Tables) -> DataFrame:
    return drift.output_drift(t.versions)


def _decisions(t: Tables) -> DataFrame:
    flags = drift.output_drift(t.versions).select("name", F.col("drifted").alias("output_drifted"))
    inputs = drifted_features(t).agg(F.array_sort(F.collect_list("feature")).alias("f")).scalar()
    scores = t.versions.join(flags, "name").withColumn("drifted_features", inputs)
    return drift.retrain_decision(scores)


@query
def retrain_decision(t: Tables) -> DataFrame:
    return _decisions(t).select("id", "name", "retrain", "reasons")


@query
def request_features(t: Tables) -> DataFrame:
    found = scoring.request_features(t.requests, t.history, t.weather, t.holidays)
    return found.select("zone_id", "prediction_time", *FULL_FEATURES)


# --- models ----------------------------------------------------------------------------------------

@query
def fare_linear(t: Tables) -> DataFrame:
    trained = training.train_fare(t.clean)
    weights = regression.coefficients(trained.model, FARE_FEATURES)
    rows = F.array(*[
        F.struct(F.lit(k or "intercept").alias("term"), F.lit(v).alias("coefficient")) for k, v in weights.items()
    ])
    return trained.errors.select("mae", "mape", F.inline(rows))


@query
def fare_line(t: Tables) -> DataFrame:
    train, _ = splits.train_test(t.clean, PICKUP)
    weights = regression.coefficients(regression.fit(train, ["trip_distance"], "fare_amount"), ["trip_distance"])
    return train.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(weights["trip_distance"]).alias("slope"), F.lit(weights[""]).alias("intercept")
    )


@query
def fare_gbt(t: Tables) -> DataFrame:
    return training.train_fare(t.clean, trees=True).errors


@query
def demand_gbt(t: Tables) -> DataFrame:
    trained = training.train_demand(t.demand, regressor=regression.boosted())
    return trained.errors.withColumn("margin", trained.margins.select("margin").scalar())


def _model_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    part = F.col("split")
    return t.model_rows.where(part == "train").drop("split"), t.model_rows.where(part == "test").drop("split")


@query
def importance_cumulative(t: Tables) -> DataFrame:
    train, _ = _model_split(t)
    model = regression.fit(train, FULL_FEATURES, regressor=regression.boosted())
    gains = t.spark.createDataFrame(
        regression.gain_importances(model, FULL_FEATURES), "feature string, importance double"
    )
    return residuals.importance_shares(gains)


@query
def permutation_importance(t: Tables) -> DataFrame:
    train, test = _model_split(t)
    model = regression.fit(train, FULL_FEATURES, regressor=regression.boosted())
    return importance.permutation_importance(model, test, FULL_FEATURES)


@query
def linear_contributions(t: Tables) -> DataFrame:
    train, test = _model_split(t)
    model = regression.fit(train, FULL_FEATURES)
    return importance.linear_contributions(model, test, FULL_FEATURES, train, CELL)


@query
def tree_contributions(t: Tables) -> DataFrame:
    """Mean absolute contribution of each feature of the fitted trees over the test rows."""
    train, test = _model_split(t)
    model = regression.fit(train, FULL_FEATURES, regressor=regression.boosted())
    return importance.mean_contributions(contributions.tree_contributions(model, test), FULL_FEATURES)


@query
def log_target_compare(t: Tables) -> DataFrame:
    train, test = _model_split(t)
    plain, logged = regression.fit_many(
        [regression.Fit(train, tuple(FULL_FEATURES), log_target=log) for log in (False, True)], regression.boosted())
    both = regression.predict(logged, regression.predict(plain, test, "raw"), "logged", log_target=True)
    banded = residuals.with_demand_band(
        both, edges=residuals.COARSE_BAND_EDGES, labels=residuals.COARSE_BAND_LABELS
    )
    return banded.groupBy("demand_band").agg(
        F.count(F.lit(1)).alias("n"), residuals.mae(prediction="raw").alias("mae_raw"),
        residuals.mae(prediction="logged").alias("mae_log"),
    )


@query
def log_target_cv(t: Tables) -> DataFrame:
    """Raw and log target over expanding-window folds, with the same trees on both."""
    return regression.log_target_folds(
        regression.fold_rows(t.model_rows), CALENDAR_FEATURES, regressor=regression.boosted()
    )


@query
def ablation(t: Tables) -> DataFrame:
    return t.ablation


@query
def ablation_delta(t: Tables) -> DataFrame:
    return regression.with_step_delta(ablation(t))


@query
def ab_test_models(t: Tables) -> DataFrame:
    train, _ = _model_split(t)
    model = regression.fit(train, FULL_FEATURES, regressor=regression.boosted())
    sequence_model = sequence.fit_sequence_model(lags.sequence_windows(t.demand))
    return training.ab_test(t.demand, model, sequence_model)


@query
def monitor_month(t: Tables) -> DataFrame:
    train, _ = _model_split(t)
    return scoring.monitor_month(
        t.spark, t.trip_files, *t.newest_month, t.weather, t.holidays, t.history,
        regression.fit(train, FULL_FEATURES, regressor=regression.boosted()), t.drift_baseline, t.versions, "demand_mean",
    ).select("mae", "mape", "output_drifted", "retrain", "reasons")


@query
def cv_ttest(t: Tables) -> DataFrame:
    folds = regression.compare_folds(
        t.model_rows, {"calendar": CALENDAR_FEATURES, "full": FULL_FEATURES}, regressor=regression.boosted())
    return abtest.paired_t_test(abtest.paired_fold_errors(folds["calendar"], folds["full"]), tuple(folds))


@query
def sequence_regressor(t: Tables) -> DataFrame:
    windows = lags.sequence_windows(t.demand)
    model = sequence.fit_sequence_model(windows)
    scored = sequence.score_sequences(model, windows.where(F.col("split") == "test"))
    return residuals.zero_safe_errors(scored, "target")


@query
def zone_clusters(t: Tables) -> DataFrame:
    clusters, silhouette = clustering.zone_clusters(t.demand)
    return clusters.withColumn("silhouette", F.lit(silhouette))


@query
def high_demand_classifier(t: Tables) -> DataFrame:
    scored = classifier.classify_high_demand(t.demand)
    return training_rows.ranking_metrics(scored, "high_demand", "score")


@query
def stored_clusters(t: Tables) -> DataFrame:
    """The cluster table as it is stored: rebuilt as a whole."""
    path = fresh_path(t.spark, "clusters")
    writers.replace_rows(zone_clusters(t), path)
    return t.spark.read.parquet(path)


@query
def high_demand_report(t: Tables) -> DataFrame:
    """Class report of the fitted classifier at a probability of one half."""
    scored = classifier.classify_high_demand(t.demand).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return training_rows.class_report(scored, "high_demand", "predicted")


@query
def anomalies(t: Tables) -> DataFrame:
    return anomaly.detect_anomalies(t.demand).where("is_anomaly").select(*CELL, COUNT, "anomaly_score")


@query
def score_requests(t: Tables) -> DataFrame:
    train, test = _model_split(t)
    model = regression.fit(train, FULL_FEATURES, regressor=regression.boosted())
    margins = written(intervals.conformal_margins(regression.predict(model, test), [0.8]), "margins")
    windows = training.sequence_rows(t.demand, zones=None, newest_year=False)
    sequence_model = sequence.fit_sequence_model(windows)
    margin = intervals.margin_for(margins, 0.8)
    return scoring.score_both(t.requests, t.history, t.weather, t.holidays, model, margin, sequence_model)


@query
def predictions_logged(t: Tables) -> DataFrame:
    """Scored requests as stored rows of the predictions table."""
    path = fresh_path(t.spark, "predictions")
    writers.append_rows(scoring.prediction_log(score_requests(t), {"A": 1, "B": 2}), path)
    return t.spark.read.parquet(path)


# --- streams ---------------------------------------------------------------------------------------

def _trip_stream(t: Tables) -> DataFrame:
    return hourly.parquet_stream(t.spark, t.trip_files, t.spark.read.parquet(t.trip_files).schema)


@query
def stream_hourly_demand(t: Tables) -> DataFrame:
    out, state = fresh_path(t.spark, "stream-demand"), fresh_path(t.spark, "stream-state")
    cleaned = cleaning.plausible_trips(_trip_stream(t))
    hourly.run_to_files(hourly.hourly_demand_stream(cleaned), out, state)
    closed = t.spark.read.parquet(out).withColumn("closed", F.lit(True))
    still_open = hourly.open_hours(cleaning.plausible_trips(t.spark.read.parquet(t.trip_files)))
    return closed.unionByName(still_open.withColumn("closed", F.lit(False)))


@query
def stream_history(t: Tables) -> DataFrame:
    out, state = fresh_path(t.spark, "stream-history"), fresh_path(t.spark, "stream-state")
    cells = hourly.parquet_stream(t.spark, t.demand_files, t.demand.schema).select(*CELL, COUNT)
    hourly.run_batches(cells, hourly.insert_new_cells(out), state)
    return t.spark.read.parquet(out).drop("month")


@query
def stream_history_state(t: Tables) -> DataFrame:
    """Insert if absent by keyed state; the target is read only for what the state has forgotten."""
    out, state = fresh_path(t.spark, "stream-cells"), fresh_path(t.spark, "stream-state")
    cells = hourly.parquet_stream(t.spark, t.demand_files, t.demand.schema).select(*CELL, COUNT)
    hourly.run_by_month(hourly.first_cells(cells), out, state)
    hourly.insert_forgotten(t.demand.select(*CELL, COUNT), out)
    return hourly.stored_cells(t.spark, out)


@query
def stream_psi(t: Tables) -> DataFrame:
    out, state = fresh_path(t.spark, "stream-psi"), fresh_path(t.spark, "stream-state")
    features = ["fare_amount", "trip_distance"]
    # Stored once, as every batch reads it.
    baseline = written(drift.feature_baseline(t.clean, features, coarse_first=True), "feature-baseline")
    hourly.run_batches(_trip_stream(t), hourly.batch_drift(baseline, features, out), state)
    return t.spark.read.parquet(out).select("feature", "n", "psi")
