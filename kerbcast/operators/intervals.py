"""Prediction intervals and the cost of acting on a forecast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.ordered import quantiles
from kerbcast.schemas import COUNT


def conformal_margins(
    calibration: DataFrame, coverages: Sequence[float] = (0.8, 0.95), actual: str = COUNT,
    prediction: str = "prediction", log_scale: bool = False,
) -> DataFrame:
    """(coverage, margin): exact quantiles of the absolute residual on a calibration set."""
    y, p = F.col(actual), F.col(prediction)
    gap = F.abs(F.log1p(y) - F.log1p(p)) if log_scale else F.abs(y - p)
    found = quantiles(calibration, {"gap": gap}, coverages)
    rows = F.arrays_zip(F.array(*[F.lit(float(c)) for c in coverages]).alias("coverage"), F.col("q").alias("margin"))
    return found.select(F.inline(rows)).toDF("coverage", "margin")


def with_interval(
    df: DataFrame, margin: Column, prediction: str = "prediction", log_scale: bool = False,
    names: tuple[str, str] = ("lower", "upper"),
) -> DataFrame:
    """Bounds ``margin`` below and above the prediction, on the log(1 + x) scale if asked."""
    p = F.col(prediction)
    low, high = p - margin, p + margin
    if log_scale:
        low, high = F.expm1(F.log1p(p) - margin), F.expm1(F.log1p(p) + margin)
    return df.withColumns({names[0]: low, names[1]: high})


def margin_for(margins: DataFrame, coverage: float) -> Column:
    """One margin of ``conformal_margins`` as a scalar."""
    return margins.where(F.col("coverage") == float(coverage)).select("margin").scalar()


def interval_quality(
    df: DataFrame, actual: str = COUNT, names: tuple[str, str] = ("lower", "upper")
) -> DataFrame:
    """Share of actuals inside the bounds and the mean width."""
    low, high = F.col(names[0]), F.col(names[1])
    inside = (F.col(actual) >= low) & (F.col(actual) <= high)
    return df.agg(F.avg(inside.cast("double")).alias("coverage"), F.avg(high - low).alias("mean_width"))


def dispatch_simulation(
    df: DataFrame, predictions: Mapping[str, str], actual: str = COUNT, factor: float = 1.1
) -> DataFrame:
    """What happens if ``ceil(prediction * factor)`` drivers, at least one, are sent to every row.

    All models are evaluated in a single pass.
    """
    y = F.col(actual).cast("long")
    aggs: list[Column] = []
    for i, column in enumerate(predictions.values()):
        sent = F.greatest(F.ceil(F.col(column) * F.lit(float(factor))).cast("long"), F.lit(1).cast("long"))
        served, missed = F.least(sent, y), F.greatest(y - sent, F.lit(0))
        aggs += [
            F.bround(F.avg(served / sent), 3).alias(f"u{i}"),
            F.bround(F.avg((missed > 0).cast("double")), 3).alias(f"r{i}"),
            F.sum(missed).alias(f"m{i}"), F.sum(sent - served).alias(f"w{i}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("model"), F.col(f"u{i}").alias("utilization_rate"),
            F.col(f"r{i}").alias("unfulfilled_trip_rate"), F.col(f"m{i}").alias("total_unfulfilled"),
            F.col(f"w{i}").alias("wasted_driver_slots"),
        )
        for i, name in enumerate(predictions)
    ])
    return df.agg(*aggs).select(F.inline(rows))
