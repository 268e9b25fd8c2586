"""Regression on feature columns: fitting, scoring, folds and ablation.

Any ``pyspark.ml`` regressor can be passed; for those, missing feature values must be filled or dropped before.
``boosted()`` learns where missing values go, and fits that belong together run as one series of jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.models.boosting import Boosted, BoostedModel, Fit, fit_all
from kerbcast.operators.residuals import mae
from kerbcast.operators.splits import fold, with_fold_segment
from kerbcast.operators.validation import require_columns
from kerbcast.schemas import COUNT
from kerbcast.session import written


def linear(**params) -> LinearRegression:
    """Ordinary least squares by the normal equations, one pass over the rows."""
    return LinearRegression(**{"solver": "normal", "regParam": 0.0, **params})


def boosted(**params) -> Boosted:
    """Gradient-boosted trees of full size unless told otherwise."""
    return Boosted(**params)


def fit(
    train: DataFrame, features: Sequence[str], target: str = COUNT, regressor=None,
    weight: str | None = None, log_target: bool = False,
) -> Model | BoostedModel:
    """A fitted model; ``log_target`` fits log(1 + target)."""
    return fit_many([Fit(train, tuple(features), target, weight, log_target)], regressor)[0]


def fit_many(fits: Sequence[Fit], regressor=None) -> list[Model | BoostedModel]:
    """One model per fit; boosted trees are grown together, other regressors one after another."""
    for f in fits:
        require_columns(f.rows, [*f.features, f.target])
    if isinstance(regressor, Boosted):
        return fit_all(fits, regressor)
    return [_fit_pipeline(f, regressor or linear()) for f in fits]


def _fit_pipeline(f: Fit, regressor) -> Model:
    """A pipeline of assembler and regressor."""
    regressor = regressor.copy()
    label = F.log1p(f.target) if f.log_target else F.col(f.target)
    rows = f.rows.select(*f.features, label.cast("double").alias("_label"), *([f.weight] if f.weight else []))
    regressor.setLabelCol("_label").setFeaturesCol("_features").setPredictionCol("_prediction")
    if f.weight:
        regressor.setWeightCol(f.weight)
    assembler = VectorAssembler(inputCols=list(f.features), outputCol="_features")
    return Pipeline(stages=[assembler, regressor]).fit(rows)


def predict(
    model: Model, df: DataFrame, name: str = "prediction", log_target: bool = False
) -> DataFrame:
    """All input columns plus the prediction, mapped back if the target was logged."""
    value = F.expm1("_prediction") if log_target else F.col("_prediction")
    return model.transform(df).withColumn(name, value).drop("_features", "_prediction")


def fold_rows(demand: DataFrame, n_splits: int = 5) -> DataFrame:
    """Rows with their fold segment, written once because every fold reads them again."""
    return written(with_fold_segment(demand, n_splits), "folds")


def _whole_folds(parts: DataFrame, n_splits: int) -> list[int]:
    """Folds that have rows to learn from and rows to test on."""
    present = {r["segment"] for r in parts.select("segment").distinct().collect()}
    return [i for i in range(n_splits) if i + 1 in present and any(s <= i for s in present)]


def _fold_errors(
    parts: DataFrame, runs: Mapping[str, tuple[Sequence[str], bool]], target: str, regressor, n_splits: int
) -> DataFrame:
    """(run, fold, mae) of several runs, each with its features and whether the target is logged.

    All models of all runs are fitted together.
    """
    folds = _whole_folds(parts, n_splits)
    plan = [(run, i) for run in runs for i in folds]
    models = fit_many(
        [Fit(fold(parts, i)[0], tuple(runs[run][0]), target, log_target=runs[run][1]) for run, i in plan], regressor)
    results = [
        predict(model, fold(parts, i)[1], log_target=runs[run][1])
        .agg(F.lit(run).alias("run"), F.lit(i).alias("fold"), mae(target).alias("mae"))
        for (run, i), model in zip(plan, models)
    ]
    empty = parts.sparkSession.createDataFrame([], "run string, fold int, mae double")
    return reduce(DataFrame.unionByName, results, empty)


def cross_validate(
    demand: DataFrame, features: Sequence[str], target: str = COUNT, regressor=None,
    n_splits: int = 5, log_target: bool = False,
) -> DataFrame:
    """(fold, mae) over expanding-window folds, refitted per fold; folds lacking rows are skipped.

    Takes plain demand rows or the result of ``fold_rows``, which several calls can share.
    """
    parts = demand if "segment" in demand.columns else fold_rows(demand, n_splits)
    return _fold_errors(parts, {"": (features, log_target)}, target, regressor, n_splits).drop("run")


def compare_folds(
    demand: DataFrame, lists: Mapping[str, Sequence[str]], target: str = COUNT, regressor=None, n_splits: int = 5
) -> dict[str, DataFrame]:
    """(fold, mae) per feature list over shared folds, all models fitted together."""
    parts = demand if "segment" in demand.columns else fold_rows(demand, n_splits)
    runs = {name: (features, False) for name, features in lists.items()}
    errors = written(_fold_errors(parts, runs, target, regressor, n_splits), "fold-errors")
    return {name: errors.where(F.col("run") == name).drop("run") for name in lists}


# The steps of the feature ablation, each with its full feature list.
ABLATION_STEPS = {
    "v1 baseline": ["PULocationID", "pickup_hour", "pickup_dow", "pickup_week", "is_holiday"],
    "+ lag_24h": ["PULocationID", "pickup_hour", "pickup_dow", "pickup_week", "is_holiday", "lag_24h"],
    "+ lag_24h + lag_168h": ["PULocationID", "pickup_hour", "pickup_dow", "pickup_week", "is_holiday",
                             "lag_24h", "lag_168h"],
    "+ snowfall": ["PULocationID", "pickup_hour", "pickup_dow", "pickup_week", "is_holiday",
                   "lag_24h", "lag_168h", "snowfall"],
    "+ is_airport": ["PULocationID", "pickup_hour", "pickup_dow", "pickup_week", "is_holiday",
                     "lag_24h", "lag_168h", "snowfall", "is_airport"],
}
# End of fixed values.


def ablation(
    demand: DataFrame, steps: Mapping[str, Sequence[str]] | None = None, regressor=None, n_splits: int = 5
) -> DataFrame:
    """(step, label, cv_mae, cv_std) per feature list; steps whose folds all lack rows are absent."""
    steps, parts = steps or ABLATION_STEPS, fold_rows(demand, n_splits)
    runs = {label: (features, False) for label, features in steps.items()}
    errors = _fold_errors(parts, runs, COUNT, regressor, n_splits)
    place = F.create_map(*[x for i, label in enumerate(steps) for x in (F.lit(label), F.lit(i))])
    return errors.groupBy(place[F.col("run")].alias("step"), F.col("run").alias("label")).agg(
        F.avg("mae").alias("cv_mae"), F.stddev_pop("mae").alias("cv_std"))


def with_step_delta(steps: DataFrame, value: str = "cv_mae") -> DataFrame:
    """Change against the previous step; one row per step."""
    return steps.withColumn("delta", F.col(value) - F.lag(value).over(Window.orderBy("step")))


def log_target_folds(
    demand: DataFrame, features: Sequence[str], target: str = COUNT, regressor=None, n_splits: int = 5
) -> DataFrame:
    """(fold, mae_raw, mae_log) and the mean and population deviation of both over the folds, which are shared."""
    parts = demand if "segment" in demand.columns else fold_rows(demand, n_splits)
    runs = {"mae_raw": (features, False), "mae_log": (features, True)}
    errors = _fold_errors(parts, runs, target, regressor, n_splits)
    folds = written(
        errors.groupBy("fold").agg(*[F.max(F.when(F.col("run") == r, F.col("mae"))).alias(r) for r in runs]),
        "log-folds")
    over = [(name, how) for name in ("mae_raw", "mae_log") for how in (F.avg, F.stddev_pop)]
    names = ["cv_mae_raw", "cv_std_raw", "cv_mae_log", "cv_std_log"]
    return folds.select(
        "*", *[folds.agg(how(name)).scalar().alias(label) for (name, how), label in zip(over, names)]
    )


def coefficients(model: Model, features: Sequence[str]) -> dict[str, float]:
    """Coefficients by feature name, and the intercept under the empty name."""
    fitted = model.stages[-1]
    return {**dict(zip(features, map(float, fitted.coefficients))), "": float(fitted.intercept)}


def gain_importances(model: BoostedModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Mean gain per split of each feature of fitted trees, as shares of one."""
    return list(zip(features, map(float, model.gains())))
