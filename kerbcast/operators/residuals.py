"""Forecast errors: overall, by group, and over time.

Every function takes a frame with the actual value and a prediction column; the defaults are
``trip_count`` and ``prediction``. The residual is prediction minus actual.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.functions.ordered import quantile, quantile_list
from kerbcast.functions.scalars import absolute_percentage, cut
from kerbcast.schemas import COUNT, HOUR_TS, ZONE

TOP = float("inf")
# Edges of the demand bands; the last one is open.
BAND_EDGES = [0, 5, 15, 50, 150, TOP]
COARSE_BAND_EDGES = [0, 5, 20, 100, TOP]
# End of fixed values. The labels are our own.
BAND_LABELS = ["very low: to 5", "low: to 15", "medium: to 50", "high: to 150", "peak: over 150"]
COARSE_BAND_LABELS = ["low: to 5", "medium: to 20", "high: to 100", "peak: over 100"]
QUINTILES = ["Q1 (lowest)", "Q2", "Q3", "Q4", "Q5 (highest)"]
#: Group of rows whose actual value lies in no band.
NO_BAND = "no band: 0 or missing"


def error_columns(actual: str = COUNT, prediction: str = "prediction") -> dict[str, Column]:
    y, p = F.col(actual), F.col(prediction)
    return {
        "residual": p - y,
        "abs_error": F.abs(p - y),
        "ape": absolute_percentage(y, p),
        "rel_error": F.abs(p - y) / (y + 1),
    }


def mae(actual: str = COUNT, prediction: str = "prediction") -> Column:
    return F.avg(error_columns(actual, prediction)["abs_error"])


def mape(actual: str = COUNT, prediction: str = "prediction") -> Column:
    return F.avg(error_columns(actual, prediction)["ape"])


def forecast_errors(
    df: DataFrame, actual: str = COUNT, prediction: str = "prediction", digits: int | None = 2
) -> DataFrame:
    """MAE and MAPE in one row, rounded half to even unless ``digits`` is None."""
    shown = (lambda c: F.bround(c, digits)) if digits is not None else (lambda c: c)
    return df.agg(
        shown(mae(actual, prediction)).alias("mae"), shown(mape(actual, prediction)).alias("mape")
    )


def zero_safe_errors(df: DataFrame, actual: str = COUNT, prediction: str = "prediction") -> DataFrame:
    """MAE, and MAPE with a denominator of 1 where the actual is 0."""
    y, p = F.col(actual), F.col(prediction)
    base = F.when(y == 0, F.lit(1.0)).otherwise(y)
    return df.agg(mae(actual, prediction).alias("mae"), F.avg(F.abs((y - p) / base)).alias("mape_zero_safe"))


def compare_predictions(df: DataFrame, predictions: Mapping[str, str], actual: str = COUNT) -> DataFrame:
    """MAE and MAPE of several prediction columns, from one pass over the rows."""
    aggs = []
    for i, column in enumerate(predictions.values()):
        aggs += [mae(actual, column).alias(f"mae{i}"), mape(actual, column).alias(f"mape{i}")]
    rows = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"mae{i}").alias("mae"), F.col(f"mape{i}").alias("mape"))
        for i, name in enumerate(predictions)
    ])
    return df.agg(*aggs).select(F.inline(rows))


def residual_summary(df: DataFrame, actual: str = COUNT, prediction: str = "prediction") -> DataFrame:
    """Bias, population deviation, exact 95th percentile of absolute errors, and MAE against the mean."""
    e = error_columns(actual, prediction)
    p95 = quantile(df, e["abs_error"], 0.95)
    return df.agg(
        F.avg(e["residual"]).alias("bias"), F.stddev_pop(e["residual"]).alias("residual_std"),
        F.avg(e["abs_error"]).alias("mae"), F.avg(actual).alias("mean_actual"),
    ).select(
        "*", p95.alias("p95_abs_error"),
        F.try_divide(F.col("mae"), F.col("mean_actual")).alias("mae_over_mean"),
    )


def error_by(
    df: DataFrame, *groups: str, actual: str = COUNT, prediction: str = "prediction"
) -> DataFrame:
    """Rows, MAE, relative error in percent and mean actual per group."""
    e = error_columns(actual, prediction)
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.avg(e["abs_error"]).alias("mae"),
        (F.avg(e["rel_error"]) * 100).alias("rel_error_pct"), F.avg(actual).alias("mean_actual"),
    )


def with_demand_band(
    df: DataFrame, actual: str = COUNT, edges: Sequence[float] = tuple(BAND_EDGES),
    labels: Sequence[str] = tuple(BAND_LABELS),
) -> DataFrame:
    return df.withColumn("demand_band", cut(F.col(actual), edges, labels))


def error_by_band(df: DataFrame, actual: str = COUNT, prediction: str = "prediction", **bands) -> DataFrame:
    """Values in no band (0, missing) are a group of their own."""
    banded = with_demand_band(df, actual, **bands).withColumn("demand_band", F.coalesce("demand_band", F.lit(NO_BAND)))
    return error_by(banded, "demand_band", actual=actual, prediction=prediction)


def error_by_zone(df: DataFrame, **kw) -> DataFrame:
    return error_by(df, ZONE, **kw)


def worst_zones(df: DataFrame, n: int = 10, **kw) -> DataFrame:
    """The ``n`` zones with the largest MAE, ties by zone id."""
    return error_by_zone(df, **kw).orderBy(F.desc("mae"), ZONE).limit(n)


def error_by_hour(df: DataFrame, **kw) -> DataFrame:
    return error_by(df, "pickup_hour", **kw)


def worst_hours(df: DataFrame, **kw) -> DataFrame:
    """The hours of day with the largest absolute and the largest relative error."""
    return error_by_hour(df, **kw).agg(
        F.max_by("pickup_hour", F.struct("mae", -F.col("pickup_hour"))).alias("worst_abs_hour"),
        F.max("mae").alias("worst_mae"),
        F.max_by("pickup_hour", F.struct("rel_error_pct", -F.col("pickup_hour"))).alias("worst_rel_hour"),
        F.max("rel_error_pct").alias("worst_rel_error_pct"),
    )


def error_by_week(df: DataFrame, ts: str = HOUR_TS, **kw) -> DataFrame:
    return error_by(df.withColumn("week_of_year", F.weekofyear(ts)), "week_of_year", **kw)


def weekly_stability(df: DataFrame, **kw) -> DataFrame:
    """Best and worst week and the sample coefficient of variation of the weekly MAE."""
    return error_by_week(df, **kw).agg(
        F.min("mae").alias("best_mae"), F.max("mae").alias("worst_mae"),
        F.max_by("week_of_year", F.struct("mae", -F.col("week_of_year"))).alias("worst_week"),
        F.try_divide(F.stddev_samp("mae"), F.avg("mae")).alias("coefficient_of_variation"),
    )


def bias_by_quintile(df: DataFrame, actual: str = COUNT, prediction: str = "prediction") -> DataFrame:
    """Mean residual per quintile of the actual. Equal values always share a quintile."""
    edges = quantile_list(df, F.col(actual), [0, 0.2, 0.4, 0.6, 0.8, 1])
    tagged = df.withColumn("_edges", edges)
    y, e = F.col(actual), F.col("_edges")
    # Right-closed bins, the lowest value included.
    position = F.greatest(F.size(F.filter(e, lambda x: x < y)) - 1, F.lit(0))
    names = F.array(*[F.lit(q) for q in QUINTILES])
    return (
        tagged.withColumn("demand_quintile", names[position])
        .groupBy("demand_quintile")
        .agg(F.avg(F.col(prediction) - y).alias("mean_residual"), F.count(F.lit(1)).alias("n"))
    )


def cv_errors(folds: DataFrame, actual: str = COUNT, prediction: str = "prediction") -> DataFrame:
    return folds.groupBy("fold").agg(mae(actual, prediction).alias("mae"))


def cv_summary(fold_errors: DataFrame, digits: int = 3) -> DataFrame:
    """Mean, population deviation, extremes and the list of fold errors in fold order."""
    shown = lambda c: F.bround(c, digits)
    ordered = F.array_sort(F.collect_list(F.struct("fold", "mae")))
    return fold_errors.agg(
        shown(F.avg("mae")).alias("mean"), shown(F.stddev_pop("mae")).alias("std"),
        shown(F.min("mae")).alias("min"), shown(F.max("mae")).alias("max"),
        F.transform(ordered, lambda f: shown(f["mae"])).alias("folds"),
    )


def importance_shares(importances: DataFrame, feature: str = "feature", value: str = "importance") -> DataFrame:
    """Features by falling importance with their cumulative share; one row per feature."""
    ranked = Window.orderBy(F.desc(value), feature)
    running = ranked.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(value).over(Window.partitionBy())
    return importances.select(
        feature, value,
        F.try_divide(F.sum(value).over(running), total).alias("cumulative_share"),
    )
