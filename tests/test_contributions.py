"""Contributions of fitted trees against the definition: every coalition of features, every order."""

import itertools
import math

import numpy as np
import pytest

from kerbcast.models import contributions, importance
from kerbcast.models.boosting import Boosted, Fit, Tree, binned, fit_all

FEATURES = ("a", "b", "c", "d")


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(8)
    n = 400
    a, b, d = rng.integers(0, 8, n), rng.normal(size=n).round(1), rng.integers(0, 3, n)
    c = np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 4, n))
    y = a * b + np.where(np.isnan(c), 5, c) * (d == 1) + rng.normal(size=n).round(2)
    w = rng.integers(1, 3, n)
    rows = [(i, float(a[i]), float(b[i]), None if np.isnan(c[i]) else float(c[i]), float(d[i]), float(y[i]), float(w[i]))
            for i in range(n)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y double, w double")
    return df, fit_all([Fit(df, FEATURES, "y", "w")], Boosted(trees=5, depth=5, rate=0.3))[0]


def value_of(model, tree, bins, coalition, node=0):
    """The tree's value for one row if only the features of the coalition are known."""
    record = tree.nodes[node]
    if record["feature"] < 0:
        return float(record["value"])
    left, right = tree.left[node], tree.right[node]
    f = int(record["feature"])
    if f in coalition:
        missing = bins[f] == model.layout.sizes[f]
        return value_of(model, tree, bins, coalition, left if (record["missing_left"] if missing else bins[f] <= record["bin"]) else right)
    p, q = (float(tree.nodes["cover"][c]) for c in (left, right))
    return (p * value_of(model, tree, bins, coalition, left) + q * value_of(model, tree, bins, coalition, right)) / (p + q)


def by_definition(model, bins):
    k = len(model.features)
    out = np.zeros(k)
    for tree in map(Tree, model.trees):
        for size in range(k):
            weight = math.factorial(size) * math.factorial(k - size - 1) / math.factorial(k)
            for f in range(k):
                for others in itertools.combinations([g for g in range(k) if g != f], size):
                    out[f] += weight * (value_of(model, tree, bins, {*others, f}) - value_of(model, tree, bins, set(others)))
    return out


def test_equals_the_definition(fitted):
    df, model = fitted
    assert max(int(n["id"].max()).bit_length() for n in model.trees) == 6  # features recur on the way down
    rows = sorted(contributions.tree_contributions(model, df, ["id"]).collect())[:25]
    given = sorted(df.collect())[:25]
    for got, row in zip(rows, given):
        columns = [np.array([np.nan if row[f] is None else row[f]]) for f in FEATURES]
        expected = by_definition(model, binned(model.cuts, columns)[0])
        assert [got[f"contribution_{f}"] for f in FEATURES] == pytest.approx(expected, abs=1e-9)


def test_sums_to_the_prediction(fitted):
    df, model = fitted
    both = contributions.tree_contributions(model, model.transform(df), ["id", "_prediction"]).collect()
    for r in both:
        assert r.base_value + sum(r[f"contribution_{f}"] for f in FEATURES) == pytest.approx(r["_prediction"])
    mean = {r.feature: r.importance for r in importance.mean_contributions(
        contributions.tree_contributions(model, df), FEATURES).collect()}
    for f in FEATURES:
        assert mean[f] == pytest.approx(np.mean([abs(r[f"contribution_{f}"]) for r in both]))


def test_without_rows_or_splits(fitted):
    df, model = fitted
    assert contributions.tree_contributions(model, df.limit(0)).count() == 0
    flat = fit_all([Fit(df.selectExpr("a", "1.0 as y"), ("a",), "y")], Boosted(trees=2, depth=3))[0]
    row = contributions.tree_contributions(flat, df.limit(1)).first()
    assert (row.base_value, row.contribution_a) == (1.0, 0.0)
