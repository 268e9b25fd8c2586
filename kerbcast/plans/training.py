"""Train, evaluate and record a demand or fare model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.models.importance import permutation_importance
from kerbcast.models.boosting import BoostedModel, Fit
from kerbcast.models.regression import boosted, fit, fit_many, linear, predict
from kerbcast.models.sequence import score_sequences
from kerbcast.operators.abtest import paired_errors, paired_t_test
from kerbcast.operators.cleaning import latest_year, more_trips_than, sample_share
from kerbcast.operators.demand import rows_of_busiest_zones, with_filled_weather
from kerbcast.operators.drift import feature_baseline
from kerbcast.operators.intervals import conformal_margins
from kerbcast.operators.lags import row_lags, sequence_windows, time_lags
from kerbcast.operators.residuals import forecast_errors
from kerbcast.operators.splits import train_test, with_three_way_split
from kerbcast.operators.training_rows import with_sample_weight
from kerbcast.schemas import COUNT, FARE_FEATURES, FARE_TREE_FEATURES, FULL_FEATURES, HOUR_TS, PICKUP, ZONE
from kerbcast.session import written
from kerbcast.sources.writers import run_rows, version_row


@dataclass
class Trained:
    """A fitted model and the tables that describe it."""

    model: Model | BoostedModel
    predictions: DataFrame
    errors: DataFrame
    baseline: DataFrame | None = None
    margins: DataFrame | None = None
    importances: DataFrame | None = None

    def run(self, name: str, experiment: str, features: Sequence[str], params: dict) -> DataFrame:
        named = self.errors.withColumn("model", F.lit(name))
        return run_rows(named, experiment, features, params)

    def version(self, id_: int, name: str, params: dict | None = None) -> DataFrame:
        """The model version row; reads the one row of errors."""
        row = self.errors.first()
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        return version_row(self.errors.sparkSession, id_, name, row["mae"], row["mape"], now, params)


def model_rows(demand: DataFrame, lag_by: str = "time") -> DataFrame:
    """Demand with lags and filled weather; rows without full history are dropped.

    ``lag_by="time"`` looks up the exact hour, as scoring does; ``"rows"`` shifts by rows.
    """
    if lag_by == "rows":
        lagged = row_lags(demand)
    else:
        lagged = time_lags(demand, demand, default=None).na.drop(subset=["lag_24h", "lag_168h"])
    return with_filled_weather(lagged)


def train_demand(
    demand: DataFrame, features: Sequence[str] = tuple(FULL_FEATURES), regressor=None, min_trips: float = 0,
    lag_by: str = "time", coverage: float = 0.8, explain: bool = False,
) -> Trained:
    """Weighted fit on the first 80 % of the time, errors and conformal margin on the rest.

    The margin is calibrated on the last quarter of the training time, which the model does not see
    when the margin is measured.
    """
    # Fitting reads its rows many times: both the split rows and the weighted rows are written once.
    rows = more_trips_than(model_rows(demand, lag_by), min_trips)
    rows = written(with_three_way_split(rows), "model-rows")
    train = rows.where(F.col("split") != "test")
    test = rows.where(F.col("split") == "test")
    regressor = regressor or boosted()
    weighted = written(with_sample_weight(train), "weighted-rows")
    fitting = written(with_sample_weight(rows.where(F.col("split") == "train")), "weighted-rows")
    model, calibration_model = fit_many(
        [Fit(part, tuple(features), weight="sample_weight") for part in (weighted, fitting)], regressor)
    scored = predict(model, test)
    calibration = predict(calibration_model, rows.where(F.col("split") == "calibration"))
    return Trained(
        model=model,
        predictions=scored,
        errors=forecast_errors(scored),
        baseline=feature_baseline(train, features, {ZONE}),
        margins=conformal_margins(calibration, [coverage]),
        importances=permutation_importance(model, test, features) if explain else None,
    )


def train_fare(trips: DataFrame, trees: bool = False, regressor=None, share: float = 1.0) -> Trained:
    """Fare from trip columns, split on the pickup time. ``share`` samples rows reproducibly.

    The few columns needed are written once, so that the source is read once for the copy; the split, the fit
    and the scores read the copy.
    """
    features = FARE_TREE_FEATURES if trees else FARE_FEATURES
    rows = trips if share >= 1 else sample_share(trips, share, [PICKUP, ZONE])
    kept = rows.select(PICKUP, "fare_amount", *features)
    train, test = train_test(written(kept, "fare-rows"), PICKUP)
    model = fit(train, features, "fare_amount", regressor or (boosted(depth=6) if trees else linear()))
    scored = predict(model, test)
    return Trained(model, scored, forecast_errors(scored, "fare_amount"))


def sequence_rows(demand: DataFrame, zones: int | None = None, newest_year: bool = False) -> DataFrame:
    """Sequence windows over all rows; on request over the ``zones`` busiest zones or the newest year only."""
    rows = latest_year(demand, HOUR_TS) if newest_year else demand
    rows = rows_of_busiest_zones(rows, zones) if zones else rows
    return sequence_windows(rows)


def paired_points(demand: DataFrame, carry: Sequence[str] = tuple(FULL_FEATURES)) -> DataFrame:
    """Test targets with both a feature row and a history, so that two models predict the same points."""
    lagged = with_filled_weather(row_lags(demand))
    extra = [c for c in carry if c not in (ZONE, HOUR_TS, COUNT)]
    return sequence_windows(lagged, carry=extra).where(F.col("split") == "test").drop("split")


def ab_test(demand: DataFrame, model: Model, sequence_model, features: Sequence[str] = tuple(FULL_FEATURES)) -> DataFrame:
    """Paired test of a feature model against a sequence model on the points both can predict."""
    points = paired_points(demand, features)
    both = predict(model, score_sequences(sequence_model, points), "by_features")
    errors = paired_errors(both, "by_features", "prediction", "target")
    return paired_t_test(errors, ("features", "sequence"))
