from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kerbcast.operators.splits import with_split
from kerbcast.operators.validation import (
    DEMAND_RULES, REQUEST_RULES, TRIP_RULES, check, failure_counts, failures, feature_matrix, split_valid,
    with_request_defaults,
)


@pytest.fixture
def demand_row(spark):
    return spark.createDataFrame(
        [(161, datetime(2024, 1, 1, 18), 50, 18, 2, 1, 10.0, 0.0, None, 0)],
        "PULocationID int, pickup_hour_ts timestamp_ntz, trip_count long, pickup_hour int, pickup_dow int, "
        "pickup_week int, temperature_2m double, precipitation double, snowfall double, is_holiday int",
    )


def test_valid_demand_passes(demand_row):
    assert check(demand_row, DEMAND_RULES).count() == 1


@pytest.mark.parametrize("column, value", [
    ("PULocationID", 999), ("trip_count", -1), ("is_holiday", 2), ("pickup_hour", 24), ("pickup_week", None),
    ("precipitation", -0.5),
])
def test_bad_demand_fails(demand_row, column, value):
    bad = demand_row.withColumn(column, F.lit(value).cast(demand_row.schema[column].dataType))
    with pytest.raises(ValueError, match=column):
        check(bad, DEMAND_RULES)


def test_every_failure_is_reported(demand_row):
    bad = demand_row.withColumns({"PULocationID": F.lit(0), "trip_count": F.lit(-3), "is_holiday": F.lit(None).cast("int")})
    counts = {r["column"]: r["n_failed"] for r in failure_counts(bad, DEMAND_RULES).collect()}
    assert {c for c, n in counts.items() if n} == {"PULocationID", "trip_count", "is_holiday"}
    listed = {(r["column"], r["value"]) for r in failures(bad, DEMAND_RULES).collect()}
    assert listed == {("PULocationID", "0"), ("trip_count", "-3"), ("is_holiday", None)}


@pytest.mark.parametrize("distance, ok", [(2.5, True), (0.0, False), (float("nan"), False)])
def test_trips(spark, distance, ok):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), distance, 12.0, 161)],
        "tpep_pickup_datetime timestamp_ntz, trip_distance double, fare_amount double, PULocationID int",
    )
    assert (failure_counts(df, TRIP_RULES).agg(F.sum("n_failed")).first()[0] == 0) is ok


def test_requests(spark):
    rows = [(161, 18, 2, 1), (-1, 18, 2, 1), (161, 25, 2, 1), (161, 18, 8, 1), (161, 18, 2, 0), (None, 18, 2, 1)]
    df = spark.createDataFrame(rows, "zone_id int, hour int, day_of_week int, week int")
    for c in ("is_holiday", "is_nyc_event"):
        df = df.withColumn(c, F.lit(None).cast("int"))
    for c in ("snowfall", "lag_24h", "lag_168h"):
        df = df.withColumn(c, F.lit(None).cast("double"))
    valid, bad = split_valid(with_request_defaults(df), REQUEST_RULES)
    assert (valid.count(), bad.count()) == (1, 5)


def test_missing_columns_are_named(spark, demand_row):
    with pytest.raises(ValueError, match="is_holiday"):
        failure_counts(demand_row.drop("is_holiday"), DEMAND_RULES)
    with pytest.raises(ValueError, match="nothing"):
        feature_matrix(demand_row, ["nothing"], "trip_count")
    with pytest.raises(ValueError, match="timestamp_col 'when'"):
        with_split(demand_row, "when")
