"""Files, stored tables, scoring of requests and streams."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbcast.models import regression, sequence
from kerbcast.operators import lags
from kerbcast.plans import scoring
from kerbcast.plans.tables import Tables
from kerbcast.schemas import DROPOFF, FULL_FEATURES, PICKUP, WEATHER
from kerbcast.session import fresh_path, written
from kerbcast.plans.demand_build import build_demand
from kerbcast.sources import readers, writers
from kerbcast.streaming import hourly as streams

SMALL = "/root/testdata/sf0.001"


def trips(spark, times):
    rows = [(i, t, t + timedelta(minutes=5), 2.0, 10.0, 0.0, 0.0, 161) for i, t in enumerate(times)]
    return spark.createDataFrame(
        rows, f"trip_id long, {PICKUP} timestamp_ntz, {DROPOFF} timestamp_ntz, trip_distance double, "
        "fare_amount double, Airport_fee double, extra double, PULocationID int")


def test_files_are_chosen_by_name(spark, tmp_path):
    for month, times in {"2024-01": [datetime(2024, 1, 5), datetime(2024, 2, 1)], "2024-02": [datetime(2024, 2, 29)],
                         "2023-02": [datetime(2023, 2, 1)]}.items():
        trips(spark, times).write.parquet(f"{tmp_path}/{month[:4]}/yellow_tripdata_{month}.parquet")
    load = lambda *a: sorted(r[PICKUP] for r in readers.load_clean_trips(spark, str(tmp_path), *a).collect())
    assert load(2024, 1) == [datetime(2024, 1, 5)]
    assert load(2024) == [datetime(2024, 1, 5), datetime(2024, 2, 29)]
    assert len(load()) == 3
    assert len(readers.read_trips(spark, str(tmp_path), 2024, 2).inputFiles()) == len(
        spark.read.parquet(f"{tmp_path}/2024/yellow_tripdata_2024-02.parquet").inputFiles())
    complete = {(r["file_year"], r["file_month"]): r["complete"] for r in
                readers.file_completeness(readers.read_trips(spark, str(tmp_path))).collect()}
    assert complete == {(2024, 1): True, (2024, 2): True, (2023, 2): False}
    with pytest.raises(ValueError, match="2031"):
        readers.read_trips(spark, str(tmp_path), 2031, 1)


def test_files_at_any_depth(spark, tmp_path):
    for depth, folder in enumerate(("", "a/", "a/b/", "a/b/c/d/")):
        trips(spark, [datetime(2024, 1, 5 + depth)]).coalesce(1).write.parquet(f"{tmp_path}/{folder}tripdata_2024-01-{depth}.parquet")
    spark.range(3).write.parquet(f"{tmp_path}/a/other")
    assert readers.read_trips(spark, str(tmp_path)).count() == 4
    assert readers.read_trips(spark, str(tmp_path), 2024, 1).count() == 4
    with pytest.raises(ValueError, match="2024"):
        readers.read_trips(spark, str(tmp_path), 2024, 2)


def test_repeated_weather_hours_are_refused(spark):
    hours = [(datetime(2024, 1, 5), 1.0, 0.0, 0.0)] * 2
    weather = spark.createDataFrame(hours, "pickup_hour_ts timestamp_ntz, temperature_2m double, precipitation double, snowfall double")
    holidays = spark.createDataFrame([], "date date, name string")
    with pytest.raises(ValueError, match="weather repeats"):
        build_demand(trips(spark, [datetime(2024, 1, 5, 1)]), weather, holidays)
    assert build_demand(trips(spark, [datetime(2024, 1, 5, 1)]), weather.distinct(), holidays).count() == 1


def test_unreadable_or_missing_months_are_incomplete(spark, tmp_path):
    trips(spark, [datetime(2024, 1, 31, 5)]).write.parquet(f"{tmp_path}/2024/yellow_tripdata_2024-01.parquet")
    (tmp_path / "2024" / "yellow_tripdata_2024-02.parquet").write_bytes(b"not a parquet file")
    schema = spark.read.parquet(f"{tmp_path}/2024/yellow_tripdata_2024-01.parquet").schema
    found = readers.read_trips(spark, str(tmp_path), skip_corrupt=True, schema=schema)
    rows = readers.file_completeness(found, expected=[(2024, 1), (2024, 2), (2024, 3)]).collect()
    assert {r["file_month"]: r["complete"] for r in rows} == {1: True, 2: False, 3: False}


def test_holidays_by_year(spark, tmp_path):
    for year in (2023, 2024):
        spark.createDataFrame([(f"{year}-11-11", "Veterans Day"), (f"{year}-12-25", "Christmas Day")], "date string, name string"
                              ).write.parquet(f"{tmp_path}/{year}/holidays-{year}.parquet")
    days = readers.holiday_dates(readers.read_holidays(spark, str(tmp_path)))
    assert {r["date"] for r in days.collect()} == {date(y, m, d) for y in (2023, 2024) for m, d in ((11, 11), (12, 25))}


def test_weather_and_holiday_documents(spark, tmp_path):
    doc = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, None],
                      "precipitation": [0.0, 0.2], "snowfall": [0.0, 0.0]}, "latitude": 40.7}
    (tmp_path / "w.json").write_text(json.dumps(doc, indent=1))
    got = readers.read_weather_json(spark, str(tmp_path / "w.json")).orderBy("pickup_hour_ts").collect()
    assert [(r["pickup_hour_ts"].hour, r["temperature_2m"], r["precipitation"]) for r in got] == [(0, 1.5, 0.0), (1, None, 0.2)]
    days = [{"date": "2024-11-28", "name": "Thanksgiving", "global": True}, {"date": "2024-11-28", "name": "again"}]
    (tmp_path / "h.json").write_text(json.dumps(days))
    holidays = readers.read_holidays_json(spark, str(tmp_path / "h.json"))
    assert [r["date"] for r in readers.holiday_dates(holidays).collect()] == [date(2024, 11, 28)]


def test_history_is_inserted_once(spark):
    demand = Tables.of(spark, SMALL).demand
    path = fresh_path(spark, "history")
    writers.append_history(demand.limit(50), path)
    first = {tuple(r) for r in spark.read.parquet(path).select("zone_id", "pickup_hour_ts", "trip_count").collect()}
    for _ in range(2):
        writers.append_history(demand.withColumn("trip_count", F.col("trip_count") + 7), path)
    stored = spark.read.parquet(path)
    assert stored.count() == demand.count() == stored.select("zone_id", "pickup_hour_ts").distinct().count()
    assert first <= {tuple(r) for r in stored.select("zone_id", "pickup_hour_ts", "trip_count").collect()}


def test_equal_keys_in_one_insert_keep_one_row(spark):
    demand = Tables.of(spark, SMALL).demand
    twice = demand.union(demand.withColumn("trip_count", F.col("trip_count") + 1))
    kept = writers.new_history(writers.history_rows(twice), None)
    assert kept.count() == demand.count()
    assert kept.agg(F.sum("trip_count")).first()[0] == demand.agg(F.sum(F.col("trip_count") + 1)).first()[0]


def test_demand_is_written_by_year(spark, tmp_path):
    demand = Tables.of(spark, SMALL).demand
    later = demand.withColumn("pickup_hour_ts", F.col("pickup_hour_ts") + F.make_dt_interval(F.lit(366)))
    writers.write_demand(demand.union(later), str(tmp_path / "d"))
    back = readers.read_demand(spark, str(tmp_path / "d"))
    assert back.count() == 2 * demand.count()
    assert back.where("year = 2025").drop("year").exceptAll(later.select(back.drop("year").columns)).count() == 0
    assert back.schema["pickup_hour_ts"].dataType.simpleString() == "timestamp_ntz"


def test_runs(spark):
    metrics = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 0.5)], "model string, mae double, mape double")
    rows = writers.run_rows(metrics, "demand", ["x", "y"], {"n_estimators": 300}, {"source": "old"})
    path = fresh_path(spark, "runs")
    writers.append_rows(rows, path)
    writers.append_rows(writers.run_rows(metrics, "fare", [], {}), path)
    stored = spark.read.schema(writers.RUN_SCHEMA).parquet(path)
    assert stored.count() == 4
    row = stored.where("run_name = 'a' AND experiment = 'demand'").first()
    assert row["metrics"] == {"mae": 1.0} and row["params"] == {"n_estimators": "300", "features": "x, y"}
    assert writers.search_runs(stored).where("n_estimators = '300'").count() == 2
    old = [{"run_name": "fare", "experiment": "fare", "params": {"depth": 6}, "features": ["x"], "metrics": {"mae": 2, "mape": None}}]
    record = writers.runs_from_records(spark, old, {"source": "historical"}).first()
    assert record["params"] == {"depth": "6", "features": "x"} and record["metrics"] == {"mae": 2.0}
    assert record["tags"] == {"source": "historical"}


def test_scoring(spark, hourly):
    history = hourly([1, 132, 161], 400, lambda z, h: (z + h) % 24).withColumns({
        "zone_id": F.col("PULocationID"), "is_holiday": F.lit(0), **{c: F.lit(None).cast("double") for c in WEATHER},
    })
    history = history.where("zone_id != 161 OR pickup_hour_ts < '2024-01-01 20:00:00'")
    weather = spark.createDataFrame([(datetime(2024, 1, 10, 18), 1.0, 0.0, 2.5)], "pickup_hour_ts timestamp_ntz, temperature_2m double, precipitation double, snowfall double")
    holidays = spark.createDataFrame([(date(2024, 1, 10), "x")], "date date, name string")
    asked = [(z, datetime(2024, 1, 10, 18, 30)) for z in (1, 132, 161)]
    requests = spark.createDataFrame(asked, "zone_id int, prediction_time timestamp_ntz")
    features = scoring.request_features(requests, history, weather, holidays)
    row = features.where("zone_id = 132").first()
    at = (datetime(2024, 1, 10, 18) - datetime(2024, 1, 1)).total_seconds() / 3600
    assert (row["lag_24h"], row["lag_168h"]) == ((132 + at - 24) % 24, (132 + at - 168) % 24)
    assert (row["snowfall"], row["is_holiday"], row["is_airport"], row["pickup_hour"], row["pickup_dow"]) == (2.5, 1, 1, 18, 2)
    assert features.where("zone_id = 161").first()["lag_24h"] == 0.0

    train = features.withColumn("trip_count", F.col("lag_24h") - 30)
    model = regression.fit(train.unionByName(train.withColumn("lag_24h", F.col("lag_24h") + 1)), FULL_FEATURES)
    scored = scoring.score_requests(features, model, F.lit(4.0)).collect()
    assert all(r["predicted_trips"] == 0.0 and r["lower_bound"] == 0.0 and r["upper_bound"] == 4.0 for r in scored)

    long = history.where("zone_id != 161")
    seq = sequence.fit_sequence_model(lags.sequence_windows(long))
    answers = {r["zone_id"]: r for r in scoring.score_with_history(requests, history, seq).collect()}
    assert answers[1]["error"] is None and answers[1]["predicted_trips"] >= 0
    assert answers[161]["error"] == "not enough history for zone 161"
    both = scoring.score_both(requests, history, weather, holidays, model, F.lit(4.0), seq)
    assert both.count() == 3
    log = scoring.prediction_log(both, {"A": 10, "B": 11})
    assert log.where("model_version_id NOT IN (10, 11)").count() == 0 and log.count() <= 3


def test_monitoring_row(spark):
    t = Tables.of(spark, "/root/testdata/sf0.01")
    scored = t.scored.join(t.lagged.select("PULocationID", "pickup_hour_ts", "lag_24h"), ["PULocationID", "pickup_hour_ts"])
    row = scoring.monitor(scored, t.drift_baseline, t.versions, "demand_mean", ["pickup_hour"]).first()
    assert row["retrain"] and "percentage error" in row["reasons"] and row["mae"] == 0.86


def test_stream_closes_hours_behind_the_watermark(spark, tmp_path):
    start = datetime(2024, 5, 1)
    first = [start + timedelta(minutes=20 * i) for i in range(30)]       # ten hours
    more = [start + timedelta(hours=9, minutes=45)]
    late = [start + timedelta(minutes=5), start + timedelta(hours=9, minutes=50)]
    last = [start + timedelta(hours=20)]
    path = str(tmp_path / "in")
    for part in (first, more, late, last):
        trips(spark, part).coalesce(1).write.mode("append").parquet(path)
    stream = streams.parquet_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    out = str(tmp_path / "out")
    streams.run_to_files(streams.hourly_demand_stream(stream), out, str(tmp_path / "state"))
    got = {r["pickup_hour_ts"].hour: r["trip_count"] for r in spark.read.parquet(out).collect()}
    assert got == {**{h: 3 for h in range(9)}, 9: 5}     # the first late trip is dropped, the second counted
    still_open = streams.open_hours(spark.read.parquet(path)).collect()
    assert [(r["pickup_hour_ts"].hour, r["trip_count"]) for r in still_open] == [(20, 1)]


def test_stream_insert_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = Tables.of(spark, SMALL).demand.select("PULocationID", "pickup_hour_ts", "trip_count")
    write = streams.insert_new_cells(out)
    write(batch, 0)
    write(batch.withColumn("trip_count", F.lit(0).cast("long")), 0)
    assert spark.read.parquet(out).drop("month").exceptAll(batch).count() == 0
    assert spark.read.parquet(out).count() == batch.count()


def test_appends_read_the_months_they_touch(spark, tmp_path):
    path, demand = str(tmp_path / "h"), Tables.of(spark, SMALL).demand
    later = demand.withColumn("pickup_hour_ts", F.col("pickup_hour_ts") + F.make_dt_interval(F.lit(366)))
    writers.append_history(demand.union(later), path)
    rows = writers.history_rows(demand).withColumn("month", F.date_format("pickup_hour_ts", "yyyy-MM"))
    months = {r["month"] for r in rows.select("month").distinct().collect()}
    plan = writers.months_of(rows, path)
    assert {f.split("month=")[1][:7] for f in spark.read.parquet(path).inputFiles()} > months
    assert {r["month"] for r in plan.select("month").distinct().collect()} == months
    assert "PartitionFilters: [month" in plan._jdf.queryExecution().executedPlan().toString()
    writers.append_history(demand, path)
    assert writers.read_history(spark, path).count() == 2 * demand.count()


def test_result_tables_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "flags")
    writers.replace_rows(spark.range(5), path)
    writers.replace_rows(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_streamed_cells_keep_the_largest_count(spark, tmp_path):
    at, out = datetime(2024, 1, 1), str(tmp_path / "out")
    rows = [(1, at, 3), (1, at, 9), (1, at, 5), (2, at, 1)]
    batch = spark.createDataFrame(rows, "PULocationID int, pickup_hour_ts timestamp_ntz, trip_count long")
    streams.insert_new_cells(out)(batch, 0)
    assert sorted((r[0], r[2]) for r in spark.read.parquet(out).collect()) == [(1, 9), (2, 1)]


def test_zones_outside_the_usual_range_are_scored(spark, hourly):
    history = hourly([265, 266, 900], 60, lambda z, h: h % 5).withColumn("zone_id", F.col("PULocationID"))
    history = history.withColumns({"is_holiday": F.lit(0), **{c: F.lit(0.0) for c in WEATHER}})
    seq = sequence.fit_sequence_model(lags.sequence_windows(history))
    requests = spark.createDataFrame([(266,), (900,), (7,)], "zone_id int")
    got = {r["zone_id"]: r["error"] for r in scoring.score_with_history(requests, history, seq).collect()}
    assert got[266] is None and got[900] is None and got[7]


def test_written_tables_cut_the_plan(spark):
    df = written(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    assert df.columns == ["id", "x"] and "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_no_query_pairs_everything_with_everything(spark):
    t = Tables.of(spark, "/root/testdata/sf0.01")
    from kerbcast.plans.queries import REGISTRY

    for name in ("demand_table", "historical_mean", "lag_by_time", "conformal_bounds", "feature_psi",
                 "request_features", "describe_trips", "sample_weights", "cv_baseline_mae", "holiday_effect"):
        plan = REGISTRY[name](t)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def test_results_do_not_depend_on_the_session_time_zone(spark):
    from kerbcast.plans.queries import REGISTRY

    before = sorted(map(tuple, REGISTRY["demand_table"](Tables(spark, SMALL)).collect()), key=str)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        after = sorted(map(tuple, REGISTRY["demand_table"](Tables(spark, SMALL)).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after
