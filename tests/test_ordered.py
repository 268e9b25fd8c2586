"""Order statistics against pandas, with ties, hot values, few pieces and missing values."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbcast.functions.ordered import _coarse, _long, _near_ranks, quantile, quantiles, running_totals
from kerbcast.operators.distribution import describe, ecdf, histogram, shape

PROBS = [0.0, 0.1, 0.25, 0.5, 0.8, 0.99, 1.0]


def frame(spark, values):
    return spark.createDataFrame(pd.DataFrame({"x": values}))


@pytest.mark.parametrize("pieces, coarse", [(1, False), (7, True), (128, False), (128, True)])
@pytest.mark.parametrize("kind", ["continuous", "ties", "hot", "negative", "one", "wide"])
def test_quantiles(spark, pieces, coarse, kind):
    rng = np.random.default_rng(5)
    values = {
        "continuous": rng.exponential(30, 2000),
        "ties": rng.integers(0, 9, 2000).astype(float),
        "hot": np.where(rng.random(3000) < 0.4, 7.0, rng.normal(0, 50, 3000)),
        "negative": -rng.exponential(1e-6, 500),
        "one": np.array([4.5]),
        "wide": rng.choice([-1.0, 1.0], 800) * 10.0 ** rng.uniform(-300, 300, 800),
    }[kind]
    got = quantiles(frame(spark, values), {"x": F.col("x")}, PROBS, pieces, coarse).first()
    assert got["n"] == len(values)
    np.testing.assert_allclose(got["q"], np.quantile(values, PROBS), rtol=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-3, 3), st.floats(-1e6, 1e6)), min_size=1, max_size=60),
       st.integers(1, 9), st.floats(0, 1), st.booleans())
def test_quantile_of_anything(spark, values, pieces, prob, coarse):
    got = quantiles(frame(spark, [float(v) for v in values]), {"x": F.col("x")}, [prob], pieces, coarse).first()
    expected = np.quantile(np.array(values, dtype=float), prob)
    assert got["q"][0] == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_coarse_intervals_rise_with_the_value(spark):
    values = np.sort(np.concatenate([-np.logspace(-200, 200, 300), [0.0], np.logspace(-200, 200, 300), np.linspace(-50, 50, 2001)]))
    steps = frame(spark, values).coalesce(1).select("x", _coarse(F.col("x")).alias("k")).toPandas()
    assert steps.sort_values("x")["k"].is_monotonic_increasing
    assert steps["k"].abs().max() <= 2**20 + 1


def test_only_rows_near_the_ranks_are_shuffled(spark):
    values = np.random.default_rng(0).exponential(30, 20000)
    long = _long(frame(spark, values), {"x": F.col("x")})
    near, held = _near_ranks(long, [0.25, 0.75])
    assert held.count() <= 4 and near.count() < 200


def test_missing_values_and_several_columns(spark):
    df = spark.createDataFrame([(1.0, 5), (None, 6), (float("nan"), 7), (3.0, 8)], "a double, b int")
    got = {r["feature"]: (r["n"], r["q"]) for r in quantiles(
        df, {"a": F.col("a"), "b": F.col("b")}, [0.5]).collect()}
    assert got == {"a": (2, [2.0]), "b": (4, [6.5])}


def test_empty_column_has_no_quantile(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert quantiles(df, {"a": F.col("a")}, [0.5]).count() == 0
    assert df.select(quantile(df, F.col("a"), 0.5).alias("q")).first()["q"] is None


@pytest.mark.parametrize("pieces", [1, 3])
def test_running_totals(spark, pieces):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"x": rng.integers(0, 40, 900) / 4, "y": rng.integers(0, 2, 900)})
    got = running_totals(
        spark.createDataFrame(pdf), {"x": F.col("x")}, {"pos": F.col("y")}, pieces
    ).orderBy("value").toPandas()
    expected = pdf.groupby("x").agg(n=("y", "size"), pos=("y", "sum"))
    assert got["value"].tolist() == expected.index.tolist()
    assert got["n_upto"].tolist() == expected["n"].cumsum().tolist()
    assert got["pos_upto"].tolist() == expected["pos"].cumsum().tolist()
    assert set(got["n_total"]) == {900}


def test_the_column_is_shuffled_once(spark):
    """All branches read the same shuffled distinct values."""
    df = frame(spark, np.random.default_rng(0).normal(size=500))
    found = quantiles(df, {"x": F.col("x")}, [0.5])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2


def test_pandas_statistics(spark):
    values = pd.Series([1, 2, 2, 3, 10, 40], dtype=float)
    df = frame(spark, values)
    row = describe(df, ["x"]).first()
    d = values.describe()
    for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "max": "max",
                         "q25": "25%", "q50": "50%", "q75": "75%"}.items():
        assert row[ours] == pytest.approx(d[theirs])
    s = shape(df, "x").first()
    assert s["skewness"] == pytest.approx(values.skew())
    assert s["kurtosis"] == pytest.approx(values.kurt())
    assert shape(frame(spark, [1.0, 2.0]), "x").first()["skewness"] is None


def test_histogram_and_ecdf(spark):
    values = np.random.default_rng(3).exponential(10, 700)
    counts, edges = np.histogram(values, bins=80)
    got = histogram(frame(spark, values), F.col("x")).orderBy("bin").toPandas()
    assert got["n"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["left_edge"], edges[:-1])
    curve = ecdf(frame(spark, [1.0, 1.0, 2.0, 5.0]), "x").orderBy("value").toPandas()
    assert curve["cdf"].tolist() == [0.5, 0.75, 1.0]
    assert histogram(frame(spark, [3.0, 3.0]), F.col("x"), 4).agg(F.sum("n")).first()[0] == 2
