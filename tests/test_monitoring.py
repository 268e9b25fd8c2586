"""PSI, drift, retraining decisions, A/B statistics."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbcast.functions.student import critical_value, two_sided_p
from kerbcast.operators import abtest, drift


def baseline(spark, **points):
    return spark.createDataFrame(
        [(k, [float(p) for p in v], 100) for k, v in points.items()],
        "feature string, breakpoints array<double>, n long",
    )


def numpy_psi(points, values):
    edges = np.array(points, dtype=float)
    edges[0], edges[-1] = -np.inf, np.inf
    share = np.clip(np.histogram(values, bins=edges)[0] / max(len(values), 1), 1e-6, None)
    share = share / share.sum()
    return float(np.sum((share - 0.1) * np.log(share / 0.1)))


@pytest.mark.parametrize("values", [
    np.linspace(0, 10, 1000), np.linspace(7, 10, 1000), np.repeat([3.0, 5.0], 50), np.array([-5.0, 50.0]),
])
def test_psi_equals_numpy(spark, values):
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    row = drift.feature_psi(df, baseline(spark, x=range(11)), ["x"]).first()
    assert row["psi"] == pytest.approx(numpy_psi(range(11), values), abs=1e-12)
    assert row["n"] == len(values)


def test_psi_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "x double")
    assert drift.feature_psi(empty, baseline(spark, x=range(11)), ["x"]).first()["psi"] == pytest.approx(0.0)


def test_baseline_skips_categorical_and_collapsed(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({
        "continuous": rng.uniform(0, 100, 500), "binary": (rng.random(500) < 0.05).astype(float),
        "category": rng.integers(1, 8, 500).astype(float),
    })
    df = spark.createDataFrame(pdf)
    stored = drift.feature_baseline(df, ["continuous", "binary", "category"], {"category"})
    assert [r["feature"] for r in stored.collect()] == ["continuous"]
    np.testing.assert_allclose(stored.first()["breakpoints"], np.percentile(pdf.continuous, np.linspace(0, 100, 11)))
    same = drift.feature_psi(df, stored, ["continuous"])
    assert drift.drifted_features(same).count() == 0
    moved = spark.createDataFrame(pd.DataFrame({"continuous": rng.uniform(80, 100, 500)}))
    assert drift.drifted_features(drift.feature_psi(moved, stored, ["continuous"])).count() == 1
    assert drift.feature_psi(moved, stored, ["other"]).count() == 0
    assert drift.feature_psi(moved, stored.limit(0), ["continuous"]).count() == 0


def versions(spark, **maes):
    start = datetime(2024, 1, 1)
    rows = [(i + 100 * k, start + timedelta(days=i), name, mae)
            for k, (name, values) in enumerate(maes.items()) for i, mae in enumerate(values)]
    return spark.createDataFrame(rows, "id long, trained_at timestamp_ntz, name string, mae double")


def test_output_drift(spark):
    slow = [5 * 1.03**i for i in range(8)]
    fast = [5 * 1.2**i for i in range(8)]
    got = {r["name"]: r for r in drift.output_drift(versions(spark, slow=slow, fast=fast, new=[1.0, 9.0])).collect()}
    assert got["fast"]["drifted"] and not got["new"]["drifted"]
    assert got["fast"]["baseline_mae"] == pytest.approx(np.mean(fast[2:7]))
    assert got["slow"]["drift_pct"] == pytest.approx(slow[7] / np.mean(slow[2:7]) - 1)
    current = spark.createDataFrame([("slow", 1.0)], "name string, current_mae double")
    assert not drift.output_drift(versions(spark, slow=slow), current).first()["drifted"]


@pytest.mark.parametrize("mae, mape, expected", [(5.0, 0.10, False), (8.0, 0.10, True), (5.0, 0.20, True), (8.0, 0.20, True)])
def test_retrain_decision(spark, mae, mape, expected):
    df = spark.createDataFrame([(mae, mape, False, [])], "mae double, mape double, output_drifted boolean, drifted_features array<string>")
    assert drift.retrain_decision(df).first()["retrain"] is expected


def test_retrain_reasons(spark):
    df = spark.createDataFrame([(7.5, 0.2, True, ["a", "b"])], "mae double, mape double, output_drifted boolean, drifted_features array<string>")
    assert drift.retrain_decision(df).first()["reasons"] == (
        "mean error 7.50 is above 7; percentage error 20.00% is above 15.00%; "
        "errors rose against earlier runs; inputs have shifted: a, b"
    )


# Values from printed t tables.
@pytest.mark.parametrize("t, dof, p", [(2.776445, 4, 0.05), (1.959964, 10**7, 0.05), (63.656741, 1, 0.01),
                                       (2.228139, 10, 0.05), (0.0, 5, 1.0), (1.0, 1, 0.5)])
def test_student_tail(t, dof, p):
    assert two_sided_p(t, dof) == pytest.approx(p, abs=2e-7)
    assert two_sided_p(-t, dof) == two_sided_p(t, dof)


def test_student_quantile_is_the_inverse():
    for dof in (1, 3, 29, 5000):
        assert two_sided_p(critical_value(0.95, dof), dof) == pytest.approx(0.05)


def test_paired_t_test(spark):
    a, b = [3.0, 5.0, 7.0, 6.0, 9.0], [2.0, 4.5, 5.0, 5.0, 6.0]
    df = spark.createDataFrame(list(zip(a, b)), "err_a double, err_b double")
    row = abtest.paired_t_test(df, ("first", "second")).first()
    d = np.array(a) - np.array(b)
    t = d.mean() / (d.std(ddof=1) / math.sqrt(5))
    assert row["t_statistic"] == pytest.approx(t)
    assert row["p_value"] == pytest.approx(two_sided_p(t, 4))
    assert row["ci_low"] == pytest.approx(d.mean() - 2.7764451 * d.std(ddof=1) / math.sqrt(5))
    assert row["winner"] == "second"
    same = abtest.paired_t_test(df.withColumn("err_b", F.col("err_a"))).first()
    assert same["winner"] is None and same["p_value"] is None


def test_routing_is_even_and_repeatable(spark):
    df = spark.range(4000)
    a = abtest.route(df.repartition(3), "id").where("variant = 'B'").agg(F.sum("id"), F.count("*")).first()
    b = abtest.route(df, "id").where("variant = 'B'").agg(F.sum("id"), F.count("*")).first()
    assert a == b and 1850 < a[1] < 2150


def test_usage_counts_versions_without_predictions(spark):
    v = versions(spark, a=[1.0, 2.0]).withColumn("mape", F.lit(0.1))
    p = spark.createDataFrame([(0,), (0,), (7,)], "model_version_id long")
    got = {r["id"]: r["prediction_count"] for r in abtest.version_usage(v, p).collect()}
    assert got == {0: 2, 1: 0}
    assert [r["id"] for r in abtest.latest_versions(v).collect()] == [1]
