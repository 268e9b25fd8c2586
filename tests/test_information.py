"""Neighbour-based mutual information against all pairs."""

import math

import numpy as np
import pytest

from kerbcast.operators import information


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 2000
    y = rng.normal(size=n).round(2)
    rows = [(i, float(y[i] + rng.normal() * 0.5), int(rng.integers(0, 3)), float(round(abs(y[i])) if i % 3 else 0), 1.0,
             None if i % 4 else 7.5, float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, near double, class int, steps double, flat double, gaps double, y double")


FEATURES = ["near", "class", "steps", "flat", "gaps"]


def digamma(n):
    return sum(1 / i for i in range(1, int(n))) - 0.5772156649015329


def all_pairs(x, y, k):
    gaps = np.maximum(np.abs(x[:, None] - x), np.abs(y[:, None] - y))
    np.fill_diagonal(gaps, information.FAR)
    distance = np.sort(gaps, axis=1)[:, k - 1]
    reach = np.maximum(distance - 1, 0)[:, None]
    nx, ny = ((np.abs(v[:, None] - v) <= reach).sum(axis=1) for v in (x, y))
    n = len(x)
    mean = sum(digamma(a) + digamma(b) for a, b in zip(nx, ny)) / n
    return distance, max(0.0, digamma(n) + digamma(k) - mean)


@pytest.mark.parametrize("cell_rows", [1024, 40])
def test_equals_all_pairs(table, cell_rows):
    points = information.lattice_points(table, FEATURES, "y", ["id"])
    found = {f: g.sort_values("row") for f, g in
             information.neighbour_distances(points, 3, cell_rows).toPandas().groupby("feature")}
    got = {r.feature: r.mutual_information for r in
           information.neighbour_information(table, FEATURES, "y", ["id"], cell_rows=cell_rows).collect()}
    for f, g in points.toPandas().groupby("feature"):
        g = g.sort_values("row")
        distance, value = all_pairs(g.x.to_numpy(), g.y.to_numpy(), 3)
        assert found[f].distance.tolist() == distance.tolist()
        assert got[f] == pytest.approx(value, abs=1e-9)
    # Half of the variance is noise: about half a nat is known; a class drawn at random tells nothing.
    assert 0.5 < got["near"] < 1.1 and got["class"] < 0.05 and got["flat"] < 0.05


def test_few_rows_and_equal_rows(spark, table):
    few = information.neighbour_information(table.limit(3), ["near"], "y", ["id"])
    assert [tuple(r) for r in few.collect()] == [("near", 0.0)]
    assert information.neighbour_information(table.limit(0), ["near"], "y", ["id"]).count() == 0
    same = table.limit(1).crossJoin(spark.range(50)).drop("id").withColumnRenamed("id", "other").selectExpr("1 as id", "near", "y")
    row = information.neighbour_information(same, ["near"], "y", ["id"]).first()
    assert row.mutual_information >= 0.0 and not math.isnan(row.mutual_information)


def test_digamma(spark):
    from pyspark.sql import functions as F
    rows = spark.range(1, 40).select("id", information.digamma(F.col("id")).alias("v")).collect()
    assert [r.v for r in rows] == pytest.approx([digamma(r.id) for r in rows], abs=1e-12)
