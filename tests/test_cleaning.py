from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbcast.operators.cleaning import (
    clean_trips, drop_incomplete, latest_year, plausible_trips, sample_rows, sample_share, threshold_shares,
)
from kerbcast.schemas import DROPOFF, PICKUP

SCHEMA = (f"{PICKUP} timestamp_ntz, {DROPOFF} timestamp_ntz, trip_distance double, fare_amount double, "
          "Airport_fee double, extra double")


def trips(spark, distance, fare, times=None):
    times = times or [datetime(2024, 1, 1, 17 + i, 28, 5) for i in range(len(fare))]
    rows = [(t, t + timedelta(minutes=10), d, f, None, 1.0) for t, d, f in zip(times, distance, fare)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("distance, fare, kept", [
    ([1.0, 2.0, 3.0], [-7.0, 4.0, 15.0], 2),
    ([1.0, 0.0, 3.0], [5.0, 2.0, 15.0], 2),
    ([0.15, 40.0, 40.1], [10.0, 10.0, 10.0], 1),
    ([1.0, 1.0, 1.0], [3.5, 150.0, 150.5], 1),
    ([0.0, 0.0, 0.0], [1.0, 1.0, 1.0], 0),
    ([float("nan"), 1.0, 1.0], [10.0, float("nan"), 10.0], 1),
])
def test_ranges(spark, distance, fare, kept):
    assert clean_trips(trips(spark, distance, fare), 2024, 1).count() == kept


def test_looser_ranges_are_parameters(spark):
    rows = plausible_trips(trips(spark, [1.0, 0.1, 3.0], [5.0, 2.0, 15.0]), distance=(0, 40), fare=(0, 150))
    assert rows.count() == 3


def test_month(spark):
    times = [datetime(2025, 1, 1, 18), datetime(2024, 1, 1, 18, 28, 5), datetime(2024, 2, 1, 18)]
    kept = clean_trips(trips(spark, [1.0] * 3, [10.0] * 3, times), 2024, 1)
    assert [r[PICKUP] for r in kept.collect()] == [times[1]]


def test_file_month_beats_nothing_else(spark):
    times = [datetime(2024, 1, 31, 23, 59), datetime(2024, 2, 1)]
    rows = trips(spark, [1.0] * 2, [10.0] * 2, times).withColumns(
        {"file_year": F.lit(2024), "file_month": F.lit(2)})
    assert [r[PICKUP] for r in clean_trips(rows).collect()] == [times[1]]


def test_fills_surcharges_and_keeps_fractional_minutes(spark):
    t = datetime(2024, 1, 1, 10, 0, 0, 250000)
    df = spark.createDataFrame([(t, t + timedelta(seconds=90, microseconds=500000), 1.0, 10.0, float("nan"), None)], SCHEMA)
    row = clean_trips(df).first()
    assert (row["Airport_fee"], row["extra"]) == (0.0, 0.0)
    assert row["trip_duration"] == pytest.approx(90.5 / 60)


def test_duration_ignores_the_session_time_zone(spark):
    t = datetime(2024, 3, 10, 1, 30)  # the clock change in New York lies inside this trip
    df = spark.createDataFrame([(t, t + timedelta(hours=2), 1.0, 10.0, None, None)], SCHEMA)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert clean_trips(df).first()["trip_duration"] == 120.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    trips(spark, [1.0], [10.0]).write.parquet(path)
    plan = clean_trips(spark.read.parquet(path), 2024, 1)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    for column in (PICKUP, "trip_distance", "fare_amount"):
        assert f"GreaterThan({column}" in pushed or f"GreaterThanOrEqual({column}" in pushed


def test_drop_incomplete_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3)], "a double, b int")
    assert [r["b"] for r in drop_incomplete(df, ["a"]).collect()] == [1]


def test_latest_year(spark):
    df = spark.createDataFrame([(datetime(2023, 5, 1),), (datetime(2024, 1, 1),), (datetime(2024, 7, 1),)], "t timestamp_ntz")
    assert latest_year(df, "t").count() == 2


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = sample_share(df.repartition(3), 0.1, ["k"]).orderBy("k").collect()
    b = sample_share(df.repartition(7), 0.1, ["k"]).orderBy("k").collect()
    assert a == b and 400 < len(a) < 600
    assert sample_rows(df.repartition(5), 100, ["k"]).count() == 100
    assert set(sample_rows(df, 100, ["k"]).collect()) == set(sample_rows(df.repartition(9), 100, ["k"]).collect())
    assert sample_rows(df.limit(10), 100, ["k"]).count() == 10


def test_threshold_shares(spark):
    df = spark.createDataFrame([(float(x),) for x in [-1, 1, 2, 3]], "x double")
    got = {(r["test"], r["threshold"]): r["share"] for r in threshold_shares(df, {"x": ([2], [2])}).collect()}
    assert got == {("at_most", 2.0): 0.5, ("below", 2.0): 0.5}
