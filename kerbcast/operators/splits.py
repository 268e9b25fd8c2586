"""Splits along time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.scalars import as_value
from kerbcast.functions.timeparts import epoch_micros
from kerbcast.operators.validation import require_columns
from kerbcast.schemas import HOUR_TS


def _ends(df: DataFrame, ts: str) -> DataFrame:
    """First and last time in microseconds, one row."""
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last")).select(
        epoch_micros(F.col("first")).alias("lo"), epoch_micros(F.col("last")).alias("hi")
    )


def _span(df: DataFrame, ts: str):
    return as_value(_ends(df, ts))


def with_split(df: DataFrame, ts: str = HOUR_TS, ratio: float = 0.8, name: str = "split") -> DataFrame:
    """``train`` before the point at ``ratio`` of the time range, ``test`` from it on."""
    if ts not in df.columns:
        raise ValueError(f"timestamp_col '{ts}' not found in columns {df.columns}")
    tagged = df.withColumn("_span", _span(df, ts))
    point = F.col("_span.lo") + (F.col("_span.hi") - F.col("_span.lo")) * F.lit(float(ratio))
    part = F.when(epoch_micros(F.col(ts)) < point, "train").when(F.col(ts).isNotNull(), "test")
    return tagged.withColumn(name, part).drop("_span")


def train_test(df: DataFrame, ts: str = HOUR_TS, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    parts = with_split(df, ts, ratio)
    return (
        parts.where(F.col("split") == "train").drop("split"),
        parts.where(F.col("split") == "test").drop("split"),
    )


def with_three_way_split(df: DataFrame, ts: str = HOUR_TS, outer: float = 0.8, inner: float = 0.75) -> DataFrame:
    """``train``, ``calibration`` and ``test``: the training part of one split is split again."""
    first = with_split(df, ts, outer)
    fitting = first.where(F.col("split") == "train")
    tagged = first.withColumn("_span", _span(fitting, ts))
    point = F.col("_span.lo") + (F.col("_span.hi") - F.col("_span.lo")) * F.lit(float(inner))
    part = F.when(F.col("split") == "test", "test").when(
        epoch_micros(F.col(ts)) < point, "train"
    ).otherwise("calibration")
    return tagged.withColumn("split", part).drop("_span")


def with_fold_segment(df: DataFrame, n_splits: int = 5, ts: str = HOUR_TS) -> DataFrame:
    """``segment`` 0..n_splits: the equal time slice ``(start, end]`` a row lies in, the first closed.

    Fold i (from 0) trains on segments 0..i and tests on segment i + 1, so one column describes every
    fold and no row is copied.
    """
    require_columns(df, [ts])
    step = (F.col("hi") - F.col("lo")) / F.lit(float(n_splits + 1))
    steps = F.array(*[step * F.lit(float(i + 1)) for i in range(n_splits)])
    slices = as_value(_ends(df, ts).select("lo", steps.alias("steps")))
    offset = epoch_micros(F.col(ts)) - F.col("_slices.lo")
    passed = F.size(F.filter("_slices.steps", lambda s: s < F.col("_offset")))
    return (
        df.withColumn("_slices", slices).withColumn("_offset", offset)
        .withColumn("segment", passed).drop("_slices", "_offset")
    )


def fold_sizes(df: DataFrame, n_splits: int = 5, ts: str = HOUR_TS) -> DataFrame:
    """Rows per fold and role, with time bounds; folds lacking either role are left out."""
    per_segment = with_fold_segment(df, n_splits, ts).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    folds = per_segment.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"), "*"
    )
    role = F.when(F.col("segment") <= F.col("fold"), "train").when(
        F.col("segment") == F.col("fold") + 1, "test"
    )
    sizes = (
        folds.withColumn("role", role).where(F.col("role").isNotNull())
        .groupBy("fold", "role")
        .agg(F.sum("n").alias("n"), F.min("first").alias("first_ts"), F.max("last").alias("last_ts"))
    )
    complete = sizes.groupBy("fold").agg(F.count(F.lit(1)).alias("roles")).where("roles = 2")
    return sizes.join(complete.select("fold"), "fold", "left_semi")


def fold(df: DataFrame, index: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of one fold of a frame that carries ``segment``."""
    return df.where(F.col("segment") <= index), df.where(F.col("segment") == index + 1)
