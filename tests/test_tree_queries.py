"""Queries that stand for boosted models fit boosted trees, all at once and of full size."""

import pytest

from kerbcast.models import regression
from kerbcast.models.boosting import Boosted
from kerbcast.plans import queries
from kerbcast.plans.tables import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def series(monkeypatch):
    """Number of fits and regressor of every series of fits."""
    seen, fit_all = [], regression.fit_all

    def noted(fits, spec=None):
        seen.append((len(fits), spec))
        return fit_all(fits, spec)

    monkeypatch.setattr(regression, "fit_all", noted)
    return seen


@pytest.fixture(scope="module")
def small(spark):
    return Tables(spark, SMALL)


@pytest.mark.parametrize("name, models", [
    ("permutation_importance", 1), ("log_target_compare", 2), ("ab_test_models", 1), ("monitor_month", 1),
    ("score_requests", 1), ("cv_ttest", 10), ("log_target_cv", 10), ("ablation", 25)])
def test_trees_are_fitted(series, small, name, models):
    assert getattr(queries, name)(small).count() > 0
    (fits, spec), = series
    assert 0 < fits <= models and spec == Boosted(trees=300, depth=9, rate=0.05)


def test_log_target_folds(spark, hourly):
    demand = hourly([1, 2, 3], 120, lambda z, h: 2 ** (h % 5 + z))
    features = ["PULocationID", "pickup_hour"]
    rows = regression.log_target_folds(demand, features, n_splits=3).orderBy("fold").collect()
    for name, log in (("raw", False), ("log", True)):
        folds = regression.cross_validate(demand, features, n_splits=3, log_target=log).orderBy("fold").collect()
        mae = [r["mae"] for r in folds]
        assert [r[f"mae_{name}"] for r in rows] == pytest.approx(mae) and len(mae) == 3
        mean = sum(mae) / 3
        assert {round(r[f"cv_mae_{name}"], 9) for r in rows} == {round(mean, 9)}
        assert rows[0][f"cv_std_{name}"] == pytest.approx((sum((m - mean) ** 2 for m in mae) / 3) ** 0.5)
