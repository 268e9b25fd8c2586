"""Forecast from the previous rows of a zone: regression on the flattened history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.operators.abtest import clipped
from kerbcast.schemas import SEQUENCE_FEATURES


def flat_history(windows: DataFrame, features: Sequence[str] = tuple(SEQUENCE_FEATURES)) -> DataFrame:
    """The history as one vector, oldest row first, missing values as 0."""
    flat = F.flatten(F.transform("history", lambda h: F.array(*[
        F.coalesce(h[f].cast("double"), F.lit(0.0)) for f in features
    ])))
    return windows.withColumn("features", array_to_vector(flat)).drop("history")


def fit_sequence_model(windows: DataFrame, penalty: float = 1.0) -> object:
    train = flat_history(windows.where(F.col("split") == "train"))
    return LinearRegression(labelCol="target", regParam=penalty, solver="normal").fit(train)


def score_sequences(model, windows: DataFrame) -> DataFrame:
    scored = model.transform(flat_history(windows)).drop("features")
    return scored.withColumn("prediction", clipped(F.col("prediction")))
