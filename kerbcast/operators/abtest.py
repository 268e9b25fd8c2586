"""Comparing two models: routing, paired tests, power, and per-version results."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.scalars import unit_hash
from kerbcast.functions.student import critical_95, needed_rows, p_value
from kerbcast.schemas import COUNT


def route(df: DataFrame, *keys: str, share_b: float = 0.5, salt: str = "ab") -> DataFrame:
    """``variant`` A or B by a hash of the request key, so that a rerun routes alike."""
    spot = unit_hash(*[F.col(k) for k in keys], salt=salt)
    return df.withColumn("variant", F.when(spot < share_b, "B").otherwise("A"))


def clipped(col: Column) -> Column:
    return F.greatest(F.lit(0.0), col)


def paired_errors(df: DataFrame, a: str, b: str, actual: str = COUNT) -> DataFrame:
    """Absolute errors of two predictions of the same row, predictions below zero raised to it."""
    y = F.col(actual)
    return df.withColumns({"err_a": F.abs(y - clipped(F.col(a))), "err_b": F.abs(y - clipped(F.col(b)))})


def paired_moments(errors: DataFrame) -> DataFrame:
    """One row: size, both means, mean difference, its sample deviation and the t statistic."""
    diff = F.col("err_a") - F.col("err_b")
    base = errors.agg(
        F.count(diff).alias("n"), F.avg("err_a").alias("mae_a"), F.avg("err_b").alias("mae_b"),
        F.avg(diff).alias("mean_diff"), F.stddev_samp(diff).alias("std_diff"),
    )
    standard_error = F.col("std_diff") / F.sqrt(F.col("n").cast("double"))
    return base.withColumn("t_statistic", F.try_divide(F.col("mean_diff"), standard_error))


def paired_t_test(errors: DataFrame, names: tuple[str, str] = ("A", "B"), alpha: float = 0.05) -> DataFrame:
    """Two-sided paired test with a 95 % interval on the difference; the winner only if significant."""
    m = paired_moments(errors)
    dof = (F.col("n") - 1).cast("double")
    half = critical_95(dof) * F.col("std_diff") / F.sqrt(F.col("n").cast("double"))
    tested = m.withColumns({"p_value": p_value(F.col("t_statistic"), dof), "half_width": half})
    better = F.when(F.col("mae_b") < F.col("mae_a"), names[1]).otherwise(names[0])
    return tested.select(
        "n", "mae_a", "mae_b", "mean_diff", "std_diff", "t_statistic", "p_value",
        (F.col("mean_diff") - F.col("half_width")).alias("ci_low"),
        (F.col("mean_diff") + F.col("half_width")).alias("ci_high"),
        F.when(F.col("p_value") < alpha, better).alias("winner"),
    )


def paired_fold_errors(a: DataFrame, b: DataFrame) -> DataFrame:
    """Fold errors of two models side by side, for a test over folds."""
    left = a.select("fold", F.col("mae").alias("err_a"))
    return left.join(b.select("fold", F.col("mae").alias("err_b")), "fold")


def power_analysis(
    errors: DataFrame, error: str = "abs_error", difference: float = 1.0, alpha: float = 0.05, power: float = 0.8
) -> DataFrame:
    """Rows per group needed to see ``difference`` in the mean error (normal approximation)."""
    z = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    base = errors.agg(F.stddev_pop(error).alias("pooled_std"), F.count(error).alias("n_actual"))
    effect = F.try_divide(F.lit(float(difference)), F.col("pooled_std"))
    return base.withColumn("effect_size", effect).withColumn(
        "n_needed", F.ceil(2 * F.pow(F.try_divide(F.lit(z), F.col("effect_size")), F.lit(2.0))).cast("long")
    ).withColumn("powered", F.col("n_actual") >= F.col("n_needed"))


def exact_power_analysis(
    errors: DataFrame, error: str = "abs_error", difference: float = 1.0, alpha: float = 0.05, power: float = 0.8
) -> DataFrame:
    """The same by the noncentral t distribution: ``n_exact`` as a fraction, ``n_needed`` rounded up, and
    whether the rows at hand suffice. Python sees the one row of results only."""
    base = errors.agg(F.stddev_pop(error).alias("pooled_std"), F.count(error).alias("n_actual")).withColumn(
        "effect_size", F.try_divide(F.lit(float(difference)), F.col("pooled_std")))
    found = base.withColumn("n_exact", needed_rows("effect_size", F.lit(alpha), F.lit(power)))
    return found.withColumn("n_needed", F.ceil(F.col("n_exact") - 1e-9).cast("long")).withColumn(
        "powered", F.col("n_actual") >= F.col("n_needed"))


def newest(df: DataFrame, n: int, ts: str, *ties: str) -> DataFrame:
    """The ``n`` newest rows; equal times are ordered by the tie columns."""
    return df.orderBy(F.desc(ts), *ties).limit(n)


def latest_versions(versions: DataFrame) -> DataFrame:
    """The newest version of every model."""
    row = F.struct(*versions.columns)
    newest_row = F.max_by(row, F.struct("trained_at", "id")).alias("v")
    return versions.groupBy("name").agg(newest_row).select("v.*")


def version_usage(versions: DataFrame, predictions: DataFrame, n: int = 10) -> DataFrame:
    """Newest versions with the number of predictions each has served, 0 when none.

    Predictions are counted per version before the join, so a version that served most of them is no
    hot key.
    """
    counts = predictions.groupBy(F.col("model_version_id").alias("id")).agg(
        F.count(F.lit(1)).alias("served")
    )
    return (
        newest(versions, n, "trained_at", "name").join(counts, "id", "left")
        .withColumn("prediction_count", F.coalesce("served", F.lit(0)).cast("long"))
        .drop("served")
    )
