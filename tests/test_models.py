"""Fitted models against direct computation or on data with a known answer."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbcast.models import anomaly, clustering, importance, regression, sequence
from kerbcast.operators import lags, residuals, training_rows
from kerbcast.operators.distribution import mutual_information, standardize
from kerbcast.operators.profiles import zone_profiles
from kerbcast.plans import training
from kerbcast.schemas import WEATHER


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({
        "PULocationID": np.arange(400), "pickup_hour_ts": [datetime(2024, 1, 1) + timedelta(hours=int(i)) for i in range(400)],
        "a": rng.normal(5, 2, 400), "b": rng.uniform(0, 1, 400), "noise": rng.normal(0, 1, 400),
    })
    pdf["trip_count"] = 3 * pdf.a - 7 * pdf.b + 2 + rng.normal(0, 0.1, 400)
    df = spark.createDataFrame(pdf).withColumn("pickup_hour_ts", F.col("pickup_hour_ts").cast("timestamp_ntz"))
    return pdf, df.cache()


def test_linear_equals_least_squares(numbers):
    pdf, df = numbers
    model = regression.fit(df, ["a", "b"])
    x = np.column_stack([pdf.a, pdf.b, np.ones(len(pdf))])
    expected = np.linalg.lstsq(x, pdf.trip_count, rcond=None)[0]
    got = regression.coefficients(model, ["a", "b"])
    np.testing.assert_allclose([got["a"], got["b"], got[""]], expected, rtol=1e-8)


def test_weights_and_log_target(numbers, spark):
    pdf, df = numbers
    weighted = regression.fit(df.withColumn("w", F.col("b") + 0.1), ["a"], weight="w")
    w = np.sqrt(pdf.b + 0.1)
    x = np.column_stack([pdf.a, np.ones(len(pdf))])
    expected = np.linalg.lstsq(x * w.to_numpy()[:, None], pdf.trip_count * w, rcond=None)[0]
    assert regression.coefficients(weighted, ["a"])["a"] == pytest.approx(expected[0])
    positive = df.withColumn("trip_count", F.expm1(F.col("b")))
    logged = regression.predict(regression.fit(positive, ["b"], log_target=True), positive, log_target=True)
    assert logged.agg(residuals.mae()).first()[0] < 1e-9


def test_contributions_add_up_to_the_prediction(numbers):
    _, df = numbers
    features = ["a", "b"]
    model = regression.fit(df, features)
    parts = importance.linear_contributions(model, df, features, carry=["PULocationID"])
    both = parts.join(regression.predict(model, df).select("PULocationID", "prediction"), "PULocationID")
    gap = F.abs(F.col("base_value") + F.col("contribution_a") + F.col("contribution_b") - F.col("prediction"))
    assert both.agg(F.max(gap)).first()[0] < 1e-9
    ranked = {r["feature"]: r["importance"] for r in importance.mean_contributions(parts, features).collect()}
    assert ranked["a"] > ranked["b"]


@pytest.mark.parametrize("pieces", [1, 16])
def test_hash_positions_are_dense(numbers, pieces):
    _, df = numbers
    got = importance.with_hash_position(df, ["PULocationID"], pieces=pieces).select("position").toPandas()
    assert sorted(got["position"]) == list(range(400))


def test_permutation_importance(numbers):
    _, df = numbers
    features = ["a", "b", "noise"]
    model = regression.fit(df, features)
    got = importance.permutation_importance(model, df, features)
    shares = {r["feature"]: r["importance"] for r in got.collect()}
    assert shares["a"] > shares["b"] > 0.5 and abs(shares["noise"]) < 0.05
    again = importance.permutation_importance(model, df.repartition(5), features)
    for r in again.collect():
        assert r["importance"] == pytest.approx(shares[r["feature"]])
    # Brute force: the partner lies half the table further in hash order.
    pdf = importance.with_hash_position(df, ["PULocationID", "pickup_hour_ts"]).toPandas().sort_values("position")
    c = regression.coefficients(model, features)
    swapped = np.roll(pdf.a.to_numpy(), -200)
    predicted = c["a"] * swapped + c["b"] * pdf.b + c["noise"] * pdf.noise + c[""]
    base = c["a"] * pdf.a + c["b"] * pdf.b + c["noise"] * pdf.noise + c[""]
    rise = np.abs(predicted - pdf.trip_count).mean() - np.abs(base - pdf.trip_count).mean()
    assert shares["a"] == pytest.approx(rise)


def test_boosted_beats_the_mean(numbers):
    _, df = numbers
    model = regression.fit(df, ["a", "b"], regressor=regression.boosted(trees=5, depth=3))
    scored = regression.predict(model, df)
    spread = df.agg(F.avg(F.abs(F.col("trip_count") - df.agg(F.avg("trip_count")).first()[0]))).first()[0]
    assert 0 < scored.agg(residuals.mae()).first()[0] < spread
    gains = dict(regression.gain_importances(model, ["a", "b"]))
    assert gains["a"] > gains["b"] and sum(gains.values()) == pytest.approx(1.0)


def test_cross_validation_and_ablation(numbers):
    _, df = numbers
    folds = regression.cross_validate(df, ["a", "b"], n_splits=3)
    assert [r["fold"] for r in folds.orderBy("fold").collect()] == [0, 1, 2]
    steps = regression.with_step_delta(regression.ablation(df, {"a": ["a"], "a + b": ["a", "b"]}, n_splits=2))
    first, second = steps.orderBy("step").collect()
    assert first["delta"] is None and second["delta"] == pytest.approx(second["cv_mae"] - first["cv_mae"]) and second["delta"] < 0


def test_training_pipeline(spark, hourly):
    demand = hourly([1, 132], 600, lambda z, h: 5 + z % 7 + (h % 24)).withColumns({
        "pickup_week": F.weekofyear("pickup_hour_ts"), "is_holiday": F.lit(0), "snowfall": F.lit(None).cast("double"),
        "temperature_2m": F.lit(1.0), "precipitation": F.lit(0.0),
        "is_airport": (F.col("PULocationID") == 132).cast("int"), "is_nyc_event": F.lit(0),
    })
    trained = training.train_demand(demand, regressor=regression.boosted(trees=3, depth=3), explain=True)
    row = trained.errors.first()
    assert row["mae"] > 0
    assert trained.margins.count() == 1 and trained.importances.count() == 10
    version = trained.version(1, "demand", {"n_estimators": 3, "learning_rate": 0.05}).first()
    assert (version["mae"], version["n_estimators"]) == (row["mae"], 3)
    run = trained.run("demand", "test", ["pickup_hour"], {"n_estimators": 3}).first()
    assert run["metrics"]["mae"] == row["mae"] and run["params"]["features"] == "pickup_hour"
    points = training.paired_points(demand)
    assert points.count() > 0 and points.where("lag_24h IS NULL OR size(history) != 24").count() == 0


def test_zone_profiles(hourly):
    demand = hourly([1, 2, 3], 24, lambda z, h: z * 10 + h).where("NOT (PULocationID = 1 AND pickup_hour = 3)")
    rows = {r["PULocationID"]: r for r in zone_profiles(demand).collect()}
    assert len(rows) == 3 and rows[1]["h5"] == 15 and rows[2]["h0"] == 20 and rows[1]["h3"] == 0


def test_clusters_separate_day_and_night(hourly):
    demand = hourly(range(1, 9), 48, lambda z, h: 50 if (h % 24 < 12) == (z % 2 == 0) else 1)
    clusters, silhouette = clustering.zone_clusters(demand, k=2, starts=3)
    found = {}
    for r in clusters.collect():
        found.setdefault(r["cluster"], set()).add(r["zone_id"] % 2)
    assert sorted(map(tuple, found.values())) == [(0,), (1,)] and silhouette > 0.99
    assert clustering.cluster_sizes(clusters).agg(F.sum("n_zones")).first()[0] == 8


@pytest.fixture(scope="module")
def unusual(hourly):
    demand = hourly([1, 2, 3, 4, 5], 200, lambda z, h: 20 + (h * 13 * z) % 11)
    for c in WEATHER:
        demand = demand.withColumn(c, (F.hash("PULocationID", "pickup_hour_ts", F.lit(c)) % 10).cast("double"))
    spike = (F.col("PULocationID") == 3) & (F.col("pickup_hour_ts") == F.lit("2024-01-05 07:00:00").cast("timestamp_ntz"))
    return demand.withColumn("is_holiday", F.lit(0)).withColumn(
        "trip_count", F.when(spike, 5000).otherwise(F.col("trip_count"))).withColumn(
        "precipitation", F.when(spike, 90.0).otherwise(F.col("precipitation")))


def test_anomalies(unusual):
    # Samples as large as the training part, so that every tree has seen the spike.
    scored = anomaly.detect_anomalies(unusual, trees=40, size=800)
    summary = anomaly.anomaly_summary(scored).first()
    assert scored.count() == 1000 and abs(summary["rate"] - 0.01) <= 0.02
    worst = anomaly.most_unusual(scored).first()
    assert (worst["PULocationID"], worst["trip_count"]) == (3, 5000)
    assert scored.where("in_train").count() == 800
    assert scored.agg(F.min("anomaly_score")).first()[0] >= -1 and scored.agg(F.max("anomaly_score")).first()[0] < 0


def test_anomalies_do_not_depend_on_partitions(unusual):
    a, b = (anomaly.detect_anomalies(unusual.repartition(n), trees=10).where("is_anomaly").select(
        "PULocationID", "pickup_hour_ts", F.round("anomaly_score", 12)).collect() for n in (2, 7))
    assert sorted(a) == sorted(b)


def test_subsamples_are_bounded(spark, unusual):
    ready = unusual.withColumn("x", F.array(F.col("trip_count").cast("double")))
    sizes = anomaly.subsamples(ready, trees=6, size=64, seed=1).groupBy("tree").count().collect()
    assert {r["count"] for r in sizes} == {64} and len(sizes) == 6


def test_label_share(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame(pd.DataFrame({"trip_count": rng.integers(0, 10000, 5000)}))
    share = training_rows.with_high_demand(df).agg(F.avg("high_demand")).first()[0]
    assert share == pytest.approx(0.25, abs=0.02)


def test_ranking_metrics_by_brute_force(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 300)
    score = np.round(y * 0.3 + rng.random(300), 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": score}))
    row = training_rows.ranking_metrics(df, "y", "s").first()
    pos, neg = score[y == 1], score[y == 0]
    auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    thresholds = sorted(set(score), reverse=True)
    recall = np.array([0] + [np.mean(pos >= t) for t in thresholds])
    precision = np.array([y[score >= t].mean() for t in thresholds])
    assert row["roc_auc"] == pytest.approx(auc)
    assert row["average_precision"] == pytest.approx(np.sum(np.diff(recall) * precision))


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    got = {r["y"]: r["class_weight"] for r in training_rows.balanced_class_weight(df, "y").collect()}
    assert got == {1: 2.0, 0: pytest.approx(4 / 6)}


def test_standardize_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 3), (6.0, 3)], "x double, c int")
    got = standardize(df, ["x", "c"]).orderBy("x").toPandas()
    x = np.array([1.0, 2.0, 6.0])
    np.testing.assert_allclose(got["x_z"], (x - x.mean()) / x.std())
    assert got["c_z"].tolist() == [0.0, 0.0, 0.0]


def test_mutual_information_ranks(spark):
    rng = np.random.default_rng(8)
    x, noise = rng.normal(size=2000), rng.normal(size=2000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "noise": noise, "y": x**3}))
    got = {r["feature"]: r["mutual_information"] for r in mutual_information(df, ["x", "noise"], "y").collect()}
    assert got["x"] == pytest.approx(np.log(10), abs=0.01) and got["noise"] < 0.1


def test_sequence_model_learns_a_copy(hourly):
    demand = hourly([1, 2], 200, lambda z, h: (h * h * z) % 24)
    for c in WEATHER:
        demand = demand.withColumn(c, F.lit(None).cast("double"))
    windows = lags.sequence_windows(demand)
    model = sequence.fit_sequence_model(windows, penalty=1e-6)
    scored = sequence.score_sequences(model, windows.where("split = 'test'"))
    assert scored.agg(residuals.mae("target")).first()[0] < 0.5
