"""Input drift by PSI, output drift by error history, and the retraining decision."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.functions.ordered import quantiles
from kerbcast.functions.scalars import as_value
from kerbcast.schemas import AIRPORT_ZONES, MAE_LIMIT, MAPE_LIMIT, OUTPUT_DRIFT_LIMIT, PSI_LIMIT

DECILES = [i / 10 for i in range(11)]
FLOOR = 1e-6


def feature_baseline(
    df: DataFrame, features: Sequence[str], categorical: Collection[str] = (), coarse_first: bool = False
) -> DataFrame:
    """(feature, breakpoints[11], n): exact deciles of the numeric features.

    Categorical features are skipped, and so are features whose deciles are not all different.
    ``coarse_first`` suits raw tables, see ``ordered.quantiles``.
    """
    columns = {f: F.col(f) for f in features if f not in categorical}
    found = quantiles(df, columns, DECILES, coarse_first=coarse_first)
    return found.select("feature", F.col("q").alias("breakpoints"), "n").where(
        F.size(F.array_distinct("breakpoints")) == len(DECILES)
    )


def feature_psi(df: DataFrame, baseline: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n, psi) for every baseline feature among ``features`` that ``df`` has.

    The baseline holds eleven numbers per feature and reaches the rows as a scalar. Rows are reduced to
    ten counts per feature before anything else happens to them.
    """
    shared = [f for f in features if f in df.columns]
    if not shared:
        return baseline.limit(0).select("feature", "n", F.lit(0.0).alias("psi"))
    kept = baseline.where(F.col("feature").isin(shared)).where(
        F.size(F.array_distinct("breakpoints")) == F.size("breakpoints")
    )
    edges = as_value(kept.agg(*[
        F.max(F.when(F.col("feature") == f, F.col("breakpoints"))).alias(f"e{i}") for i, f in enumerate(shared)
    ]))

    def bin_of(i: int, f: str) -> Column:
        # Bins are [low, high). Only the nine inner edges count: the outer bins are open-ended.
        at_or_above = [(F.col(f) >= F.col(f"_edges.e{i}")[k]) for k in range(1, 10)]
        return sum([F.when(c, 1).otherwise(0) for c in at_or_above], F.lit(0))

    cells = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x"), bin_of(i, f).alias("bin"))
        for i, f in enumerate(shared)
    ])
    counted = (
        df.select(*shared).withColumn("_edges", edges).select(F.inline(cells))
        .where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = kept.select("feature", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("bin"))
    whole = Window.partitionBy("feature")
    filled = grid.join(counted, ["feature", "bin"], "left").select(
        "feature", F.coalesce("n", F.lit(0)).alias("n")
    )
    shares = filled.withColumn("total", F.sum("n").over(whole)).withColumn(
        "share", F.greatest(F.col("n") / F.greatest(F.col("total"), F.lit(1)), F.lit(FLOOR))
    )
    scaled = shares.withColumn("share", F.col("share") / F.sum("share").over(whole))
    term = (F.col("share") - 0.1) * F.log(F.col("share") / 0.1)
    return scaled.groupBy("feature").agg(F.sum("n").alias("n"), F.sum(term).alias("psi"))


def drifted_features(psi: DataFrame, limit: float = PSI_LIMIT) -> DataFrame:
    return psi.where(F.col("psi") > limit)


def recent_inputs(history: DataFrame, n: int = 2000) -> DataFrame:
    """The newest history rows as model inputs, missing values as 0. The row count is the definition."""
    newest = history.orderBy(F.desc("pickup_hour_ts"), "zone_id").limit(n)
    return newest.select(
        F.col("zone_id").alias("PULocationID"), "pickup_hour", "pickup_dow",
        F.coalesce("is_holiday", F.lit(0)).alias("is_holiday"),
        F.coalesce("snowfall", F.lit(0.0)).alias("snowfall"),
        F.col("zone_id").isin(AIRPORT_ZONES).cast("int").alias("is_airport"),
    )


def drift_report(history: DataFrame, baseline: DataFrame, n: int = 2000) -> DataFrame:
    """One row: rows analysed, features checked, the drifted ones among them, and whether there is a baseline."""
    inputs = recent_inputs(history, n)
    psi = feature_psi(inputs, baseline, inputs.columns)
    drifted = drifted_features(psi).agg(F.array_sort(F.collect_list("feature")).alias("f"))
    return inputs.agg(F.count(F.lit(1)).alias("rows_analyzed")).select(
        "rows_analyzed",
        F.array(*[F.lit(c) for c in inputs.columns]).alias("features_checked"),
        drifted.scalar().alias("drifted_features"),
        baseline.agg((F.count(F.lit(1)) > 0).alias("b")).scalar().alias("baseline_exists"),
    )


def output_drift(
    versions: DataFrame, current: DataFrame | None = None, lookback: int = 5, limit: float = OUTPUT_DRIFT_LIMIT
) -> DataFrame:
    """Per model: is the current MAE more than ``limit`` above the mean of the runs before the newest?

    ``current`` has (name, current_mae); by default the newest run is the current one. Fewer than three
    runs never count as drift.
    """
    newest = Window.partitionBy("name").orderBy(F.desc("trained_at"), F.desc("id"))
    recent = versions.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= lookback + 1)
    stats = recent.groupBy("name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg(F.when(F.col("back") > 1, F.col("mae"))).alias("baseline_mae"),
        F.max(F.when(F.col("back") == 1, F.col("mae"))).alias("current_mae"),
    )
    if current is not None:
        stats = stats.drop("current_mae").join(current.select("name", "current_mae"), "name")
    change = F.try_divide(F.col("current_mae") - F.col("baseline_mae"), F.col("baseline_mae"))
    return stats.withColumn("drift_pct", change).withColumn(
        "drifted", (F.col("runs") >= 3) & F.coalesce(F.col("drift_pct") > limit, F.lit(False))
    )


def retrain_decision(
    scores: DataFrame, mae_limit: float = MAE_LIMIT, mape_limit: float = MAPE_LIMIT
) -> DataFrame:
    """Adds ``retrain`` and ``reasons`` to rows of (mae, mape, output_drifted, drifted_features)."""
    mae, mape = F.col("mae"), F.col("mape")
    two = lambda c: F.format_string("%.2f", c)
    reasons = F.array_compact(F.array(
        F.when(mae > mae_limit, F.concat(F.lit("mean error "), two(mae), F.lit(f" is above {mae_limit:g}"))),
        F.when(mape > mape_limit, F.concat(
            F.lit("percentage error "), two(mape * 100), F.lit(f"% is above {mape_limit:.2%}"))),
        F.when(F.col("output_drifted"), F.lit("errors rose against earlier runs")),
        F.when(F.size("drifted_features") > 0, F.concat(
            F.lit("inputs have shifted: "), F.concat_ws(", ", "drifted_features"))),
    ))
    return scores.withColumn("reasons", F.concat_ws("; ", reasons)).withColumn(
        "retrain", F.length("reasons") > 0
    )
