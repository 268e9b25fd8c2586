"""Baselines, lags, splits, folds, weights, intervals and dispatch."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbcast.operators import baselines, intervals, lags, residuals, splits, training_rows
from kerbcast.schemas import WEATHER


def test_seasonal_naive_repeats_last_week(hourly):
    demand = hourly([1], 300, lambda z, h: h)
    train, test = demand.where(F.col("trip_count") < 168), demand.where(F.col("trip_count") >= 168)
    rows = baselines.seasonal_naive(train, test).orderBy("pickup_hour_ts").collect()
    assert [r["prediction"] for r in rows] == list(range(132))


def test_seasonal_naive_falls_back_to_the_mean(hourly):
    train = hourly([1], 10, lambda z, h: h)
    unknown = hourly([7], 3, lambda z, h: 0)
    assert {r["prediction"] for r in baselines.seasonal_naive(train, unknown).collect()} == {4.5}


def test_historical_mean(hourly):
    train = hourly([1, 2], 336, lambda z, h: 100 * z + h // 168)
    points = hourly([1, 2, 99], 2, lambda z, h: 0)
    got = {(r["PULocationID"], r["pickup_hour"]): r["prediction"] for r in
           baselines.historical_mean(train, points).collect()}
    assert got[(1, 0)] == 100.5 and got[(2, 1)] == 200.5 and got[(99, 0)] == pytest.approx(150.5)


def test_row_lags_and_time_lags_differ_on_gaps(hourly):
    demand = hourly([1], 60, lambda z, h: h).where("trip_count % 10 != 3")
    by_row = lags.row_lags(demand, [1]).where("trip_count = 4").first()
    by_time = lags.time_lags(demand, demand, [1]).where("trip_count = 4").first()
    assert (by_row["lag_1h"], by_time["lag_1h"]) == (2.0, 0.0)
    assert lags.row_lags(demand, [1, 5]).count() == demand.count() - 5
    assert lags.time_lags(demand, demand, [1], default=None).where("lag_1h IS NULL").count() == 7


def test_autocorrelation_matches_pandas(hourly):
    demand = hourly([1, 2], 100, lambda z, h: (h * 7919 * z) % 23)
    series = pd.Series([(h * 7919 * 2) % 23 for h in range(100)])
    totals = demand.groupBy("PULocationID").agg(F.sum("trip_count").alias("s")).orderBy(F.desc("s")).first()
    series = pd.Series([(h * 7919 * totals["PULocationID"]) % 23 for h in range(100)])
    for r in lags.autocorrelation(demand, [1, 2, 24]).collect():
        assert r["r"] == pytest.approx(series.autocorr(r["lag"]))


def test_sequences(spark, hourly):
    demand = hourly([1, 2], 150, lambda z, h: h)
    for c in WEATHER:
        demand = demand.withColumn(c, F.lit(None).cast("double"))
    got = lags.sequence_windows(demand)
    by_split = {r["split"]: (r["n"], r["lo"], r["hi"]) for r in got.where("PULocationID = 1").groupBy("split").agg(
        F.count("*").alias("n"), F.min("target").alias("lo"), F.max("target").alias("hi")).collect()}
    # 120 rows before the cut: targets 24..119; test targets start one window after it.
    assert by_split == {"train": (96, 24.0, 119.0), "test": (6, 144.0, 149.0)}
    row = got.where("target = 50 AND PULocationID = 2").first()
    assert [h["trip_count"] for h in row["history"]] == list(range(26, 50))
    assert len(row["history"][0]) == 6


def test_short_zones_give_no_sequences(hourly):
    demand = hourly([1], 20, lambda z, h: h)
    for c in WEATHER:
        demand = demand.withColumn(c, F.lit(0.0))
    assert lags.sequence_windows(demand).count() == 0


def test_time_split(spark):
    rows = [(datetime(2024, 1, 1) + timedelta(days=i), i) for i in range(366)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, i int")
    train, test = splits.train_test(df, "t")
    assert 0.79 <= train.count() / 366 <= 0.81
    assert train.agg(F.max("i")).first()[0] + 1 == test.agg(F.min("i")).first()[0]


def test_folds_grow_and_do_not_leak(hourly):
    demand = hourly([1, 2, 3], 300, lambda z, h: h)
    sizes = splits.fold_sizes(demand, 3).collect()
    assert {r["fold"] for r in sizes} == {0, 1, 2}
    for i in range(3):
        part = {r["role"]: r for r in sizes if r["fold"] == i}
        assert part["train"]["last_ts"] < part["test"]["first_ts"]
    train_sizes = [r["n"] for r in sorted(sizes, key=lambda r: r["fold"]) if r["role"] == "train"]
    assert train_sizes == sorted(train_sizes) and len(set(train_sizes)) == 3


def test_folds_without_rows_are_skipped(hourly):
    gap = hourly([1], 600, lambda z, h: h).where("trip_count < 100 OR trip_count >= 350")
    folds = {r["fold"] for r in splits.fold_sizes(gap).collect()}
    assert folds == {2, 3, 4}
    got = {r["fold"] for r in baselines.fold_historical_mean(gap).collect()}
    assert got == folds


def test_fold_means_equal_refitting(hourly):
    demand = hourly([1, 2], 500, lambda z, h: (h * 31 * z) % 17)
    fast = {r["fold"]: r["mae"] for r in residuals.cv_errors(baselines.fold_historical_mean(demand)).collect()}
    parts = splits.with_fold_segment(demand)
    for i in range(5):
        train, test = splits.fold(parts, i)
        slow = baselines.historical_mean(train, test).agg(residuals.mae()).first()[0]
        assert fast[i] == pytest.approx(slow)


def test_cv_summary(spark):
    folds = spark.createDataFrame([(1, 4.0), (0, 2.0), (2, 9.0)], "fold int, mae double")
    row = residuals.cv_summary(folds).first()
    assert (row["mean"], row["std"], row["min"], row["max"]) == (5.0, 2.944, 2.0, 9.0)
    assert row["folds"] == [2.0, 4.0, 9.0]


def test_sample_weights(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"PULocationID": rng.integers(1, 4, 200), "trip_count": rng.integers(1, 300, 200)})
    got = training_rows.with_sample_weight(spark.createDataFrame(pdf)).toPandas()
    y = got["trip_count"]
    zone_mean = got.groupby("PULocationID")["trip_count"].transform("mean")
    inverse = 1 / (zone_mean / zone_mean.mean() + 0.1)
    expected = np.where(y >= y.quantile(0.8), 2.0, 1.0) * inverse / inverse.mean()
    np.testing.assert_allclose(got["sample_weight"], expected / expected.mean())
    assert got["sample_weight"].mean() == pytest.approx(1.0)


def test_dispatch(spark):
    df = spark.createDataFrame([(10, 12.0), (20, 18.0), (5, 6.0), (50, 40.0)], "trip_count long, prediction double")
    row = intervals.dispatch_simulation(df, {"m": "prediction"}).first()
    assert 0 <= row["utilization_rate"] <= 1
    assert (row["total_unfulfilled"], row["wasted_driver_slots"]) == (6, 6)
    perfect = intervals.dispatch_simulation(df.withColumn("prediction", F.col("trip_count").cast("double")),
                                            {"m": "prediction"}, factor=1.0).first()
    assert (perfect["utilization_rate"], perfect["total_unfulfilled"]) == (1.0, 0)


@pytest.mark.parametrize("log_scale", [False, True])
def test_conformal_coverage(spark, log_scale):
    rng = np.random.default_rng(2)
    y = rng.poisson(20, 500)
    pdf = pd.DataFrame({"trip_count": y, "prediction": np.abs(y + rng.normal(0, 4, 500)), "cal": np.arange(500) < 250})
    df = spark.createDataFrame(pdf)
    margins = intervals.conformal_margins(df.where("cal"), log_scale=log_scale)
    cal = pdf[pdf.cal]
    gap = (np.abs(np.log1p(cal.trip_count) - np.log1p(cal.prediction)) if log_scale
           else np.abs(cal.trip_count - cal.prediction))
    got = {r["coverage"]: r["margin"] for r in margins.collect()}
    assert got[0.8] == pytest.approx(np.quantile(gap, 0.8)) and got[0.95] == pytest.approx(np.quantile(gap, 0.95))
    bounded = intervals.with_interval(df.where("NOT cal"), intervals.margin_for(margins, 0.8), log_scale=log_scale)
    assert intervals.interval_quality(bounded).first()["coverage"] >= 0.7


def test_errors(spark):
    df = spark.createDataFrame([(0, 1.0), (4, 2.0), (10, 10.0)], "trip_count long, prediction double")
    exact = residuals.forecast_errors(df, digits=None).first()
    assert exact["mae"] == 1.0 and exact["mape"] > 1e14
    assert residuals.zero_safe_errors(df).first()["mape_zero_safe"] == pytest.approx(0.5)
    bands = {r["demand_band"]: r["n"] for r in residuals.error_by_band(df).collect()}
    assert bands == {"very low: to 5": 1, "low: to 15": 1, residuals.NO_BAND: 1}


def test_bands_lose_no_row(spark):
    df = spark.createDataFrame([(c, 1.0) for c in (0, 1, 9_999, 10_000, 50_000)] + [(None, 1.0)], "trip_count long, prediction double")
    bands = {r["demand_band"]: r["n"] for r in residuals.error_by_band(df).collect()}
    assert bands == {residuals.NO_BAND: 2, "very low: to 5": 1, "peak: over 150": 3}
    coarse = residuals.error_by_band(df, edges=residuals.COARSE_BAND_EDGES, labels=residuals.COARSE_BAND_LABELS)
    assert sum(r["n"] for r in coarse.collect()) == 6


@pytest.mark.parametrize("chunk", [8192, 30])
def test_autocorrelation_in_chunks(spark, hourly, chunk):
    rng = random.Random(7)
    demand = hourly([1, 2, 3], 200, lambda z, h: 5 if z == 3 else rng.randrange(50) + h % 24)
    demand = demand.unionByName(hourly([4], 2, lambda z, h: h))
    wanted = [1, 5, 24, 150]
    got = {(r.PULocationID, r.lag): r.r for r in lags.autocorrelation(demand, wanted, True, chunk).collect()}
    for zone, rows in demand.toPandas().groupby("PULocationID"):
        y = rows.sort_values("pickup_hour_ts").trip_count.astype(float)
        for lag in wanted:
            expected = y.corr(y.shift(lag)) if y.nunique() > 1 and len(y) > lag + 1 else None
            assert got.pop((zone, lag)) == (None if expected is None else pytest.approx(expected))
    assert not got
