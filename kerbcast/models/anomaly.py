"""Isolation forest: hash-chosen subsamples, one task per tree, broadcast forest for scoring."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.functions.ordered import quantile, running_totals
from kerbcast.functions.timeparts import epoch_hours
from kerbcast.operators.cleaning import drop_incomplete
from kerbcast.operators.distribution import standardize
from kerbcast.schemas import ANOMALY_FEATURES, HOUR_TS, ZONE
from kerbcast.session import written

TREE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, depth double"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` points, which normalises path lengths."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def first_share(df: DataFrame, share: float) -> DataFrame:
    """``in_train`` marks the first ``floor(rows * share)`` rows in (hour, zone) order."""
    spot = (epoch_hours(F.col(HOUR_TS)) * 1024 + F.col(ZONE)).cast("double")
    ranks = running_totals(df, {"spot": spot})
    past = F.col("n_upto") > F.floor(F.col("n_total") * F.lit(float(share)))
    limit = ranks.where(past).agg(F.min("value").alias("v")).scalar()
    return df.withColumn("in_train", F.coalesce(spot < limit, F.lit(True)))


def subsamples(train: DataFrame, trees: int, size: int, seed: int) -> DataFrame:
    """Up to ``size`` rows per tree, the ones with the smallest hash of (row, tree).

    A row is only copied for the trees where its hash lies below a limit that leaves about 1.5 times
    ``size`` rows, so the copies do not grow with the table.
    """
    rows = F.count(F.lit(1)).cast("double")
    limit = train.agg(F.least(F.lit(1.0), F.lit(1.5 * size + 64) / F.greatest(rows, F.lit(1.0))).alias("q"))
    span = float(2**53)
    chance = lambda t: F.pmod(
        F.xxhash64(F.col(ZONE), F.col(HOUR_TS), t, F.lit(seed)), F.lit(2**53)
    ) / span
    numbered = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), chance(t).alias("u"))
    )
    tagged = train.withColumn("_limit", limit.scalar())
    copies = tagged.select("x", F.inline(F.filter(numbered, lambda c: c["u"] <= F.col("_limit"))))
    order = Window.partitionBy("tree").orderBy("u")
    return copies.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= size).drop("_n")


def _grow(sample: pd.DataFrame, seed: int) -> pd.DataFrame:
    """One tree on at most a few hundred rows: random feature, random cut, until rows are alone."""
    ordered = sample.sort_values("u")
    x = np.array(ordered["x"].tolist(), dtype=float)
    tree = int(ordered["tree"].iloc[0])
    rng = np.random.default_rng([seed, tree])
    deepest = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[list[float]] = []
    waiting = [(np.arange(len(x)), 0, -1, 0)]
    while waiting:
        rows, depth, parent, side = waiting.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent][4 + side] = here
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        spread = np.flatnonzero(high > low)
        if depth >= deepest or len(rows) <= 1 or len(spread) == 0:
            nodes.append([tree, here, -1, 0.0, -1, -1, depth + average_path(len(rows))])
            continue
        feature = int(rng.choice(spread))
        at = float(rng.uniform(low[feature], high[feature]))
        nodes.append([tree, here, feature, at, -1, -1, float(depth)])
        goes_left = x[rows, feature] <= at
        waiting.append((rows[goes_left], depth + 1, here, 0))
        waiting.append((rows[~goes_left], depth + 1, here, 1))
    columns = [c.split()[0] for c in TREE_SCHEMA.split(", ")]
    out = pd.DataFrame(nodes, columns=columns)
    return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32", "right": "int32"})


def fit_forest(samples: DataFrame, seed: int) -> DataFrame:
    return samples.groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, seed), TREE_SCHEMA)


def score_rows(df: DataFrame, forest: pd.DataFrame, size: float) -> DataFrame:
    """Adds ``anomaly_score`` in [-1, 0], lower meaning more unusual, from the array column ``x``."""
    trees = [
        tuple(part.sort_values("node")[c].to_numpy() for c in ("feature", "threshold", "left", "right", "depth"))
        for _, part in forest.groupby("tree")
    ]
    shared = df.sparkSession.sparkContext.broadcast(trees)
    norm = average_path(size)
    schema = df.drop("x").schema.add("anomaly_score", "double")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.array(pdf["x"].tolist(), dtype=float).reshape(len(pdf), -1)
            total = np.zeros(len(pdf))
            every = np.arange(len(pdf))
            for feature, threshold, left, right, depth in shared.value:
                at = np.zeros(len(pdf), dtype=int)
                inner = feature[at] >= 0
                while inner.any():
                    rows, nodes = every[inner], at[inner]
                    smaller = x[rows, feature[nodes]] <= threshold[nodes]
                    at[rows] = np.where(smaller, left[nodes], right[nodes])
                    inner = feature[at] >= 0
                total += depth[at]
            mean_depth = total / max(len(shared.value), 1)
            yield pdf.drop(columns="x").assign(anomaly_score=-np.exp2(-mean_depth / norm))

    return df.mapInPandas(score, schema)


def detect_anomalies(
    demand: DataFrame, features: Sequence[str] = tuple(ANOMALY_FEATURES), contamination: float = 0.01,
    trees: int = 100, size: int = 256, seed: int = 42, train_share: float = 0.8,
) -> DataFrame:
    """Every complete row with its score and whether it falls below the training quantile.

    The forest on the driver holds at most ``trees * (2 * size - 1)`` nodes, whatever the row count.
    """
    rows = first_share(drop_incomplete(demand, features), train_share)
    train = rows.where("in_train")
    scaled = standardize(rows, features, fit_on=train)
    ready = scaled.withColumn("x", F.array(*[f"{f}_z" for f in features])).drop(*[f"{f}_z" for f in features])
    ready = written(ready, "anomaly-input")
    train = ready.where("in_train")
    forest = fit_forest(subsamples(train, trees, size, seed), seed).toPandas()
    used = min(size, train.count())
    scored = written(score_rows(ready, forest, used), "anomaly-scores")
    limit = quantile(scored.where("in_train"), F.col("anomaly_score"), contamination)
    return scored.withColumn("is_anomaly", F.col("anomaly_score") < limit)


def anomaly_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count_if("is_anomaly").alias("n_anomalies"), F.avg(F.col("is_anomaly").cast("double")).alias("rate")
    )


def most_unusual(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.where("is_anomaly").orderBy("anomaly_score", ZONE, HOUR_TS).limit(n).select(
        ZONE, HOUR_TS, "trip_count", "anomaly_score"
    )
