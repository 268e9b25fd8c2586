"""Logistic classification of high-demand hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.operators.cleaning import drop_incomplete
from kerbcast.operators.distribution import standardize
from kerbcast.operators.splits import with_split
from kerbcast.operators.training_rows import balanced_class_weight, with_high_demand
from kerbcast.schemas import CLASSIFIER_FEATURES, HOUR_TS, ZONE
from kerbcast.session import written


def prepare(demand: DataFrame, features: Sequence[str] = tuple(CLASSIFIER_FEATURES)) -> DataFrame:
    """Complete rows with the label, set before the split, and the split."""
    return with_split(with_high_demand(drop_incomplete(demand, features)))


def classify_high_demand(
    demand: DataFrame, features: Sequence[str] = tuple(CLASSIFIER_FEATURES), strength: float = 1.0
) -> DataFrame:
    """Test rows with label, score and predicted class.

    The features are scaled by the training rows, classes weigh the same, and the penalty is
    ``1 / (strength * rows)`` because Spark averages the loss where others add it up.
    """
    rows = written(prepare(demand, features), "labelled")
    train = rows.where(F.col("split") == "train")
    scaled = standardize(rows, features, fit_on=train)
    assembled = VectorAssembler(
        inputCols=[f"{f}_z" for f in features], outputCol="features"
    ).transform(scaled)
    weighted = balanced_class_weight(assembled.where(F.col("split") == "train"), "high_demand")
    fitting = written(weighted.select("features", "high_demand", "class_weight"), "weighted-rows")
    n = fitting.count()
    model = LogisticRegression(
        labelCol="high_demand", weightCol="class_weight", regParam=1.0 / (strength * n),
        standardization=False, maxIter=1000,
    ).fit(fitting)
    scored = model.transform(assembled.where(F.col("split") == "test"))
    return scored.select(
        ZONE, HOUR_TS, "high_demand", vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("predicted"),
    )
