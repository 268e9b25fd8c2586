"""What a fitted model relies on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.functions.scalars import as_value
from kerbcast.models.regression import coefficients, predict
from kerbcast.operators.residuals import mae
from kerbcast.schemas import COUNT, HOUR_TS, ZONE


def with_hash_position(df: DataFrame, keys: Sequence[str], seed: int = 42, pieces: int = 256) -> DataFrame:
    """A dense ``position`` 0..n-1 in the order of a hash of the key.

    The hash spreads rows evenly over ``pieces``; each piece is numbered on its own and shifted by the
    sizes of the pieces before it, a table of at most ``pieces`` rows.
    """
    h = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    tagged = df.withColumn("_h", h).withColumn("_piece", F.pmod(F.col("_h"), F.lit(pieces)).cast("int"))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = tagged.groupBy("_piece").agg(F.count(F.lit(1)).alias("_size")).select(
        "_piece", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_piece").orderBy("_h", *keys)
    return (
        tagged.join(F.broadcast(starts), "_piece")
        .withColumn("position", F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_h", "_piece", "_start")
    )


def permutation_importance(
    model: Model, df: DataFrame, features: Sequence[str], target: str = COUNT,
    keys: Sequence[str] = (ZONE, HOUR_TS), seed: int = 42, log_target: bool = False,
) -> DataFrame:
    """(feature, mae, importance): rise of the MAE when one feature is taken from another row.

    The other row lies half the table further in hash order, so every value is used exactly once. All
    features are moved by the same join.
    """
    placed = with_hash_position(df.select(*dict.fromkeys([*keys, *features, target])), keys, seed)
    n = F.col("_n")
    counted = placed.withColumn("_n", df.agg(F.count(F.lit(1)).alias("n")).scalar())
    half = F.floor(n / 2).cast("long")
    partner = counted.select(
        F.pmod(F.col("position") + n - half, n).alias("position"),
        *[F.col(f).alias(f"_other_{f}") for f in features],
    )
    paired = counted.drop("_n").join(partner, "position")
    # One scoring pass: every row appears once per feature, with that feature's value swapped.
    variants = F.array(*[
        F.struct(
            F.lit(f).alias("feature"),
            *[F.col(f"_other_{g}" if g == f else g).cast("double").alias(g) for g in features],
        )
        for f in features
    ])
    swapped = paired.select(F.col(target).alias("_actual"), F.inline(variants))
    scored = predict(model, swapped, log_target=log_target)
    base = predict(model, df, log_target=log_target).agg(mae(target).alias("m")).scalar()
    errors = scored.groupBy("feature").agg(mae("_actual").alias("mae"))
    return errors.withColumn("importance", F.col("mae") - base)


def linear_contributions(
    model: Model, df: DataFrame, features: Sequence[str], background: DataFrame | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Per row and feature, coefficient times distance from the mean: exact for a linear model.

    With ``base_value``, the prediction at the means, the contributions add up to the prediction.
    """
    weights = coefficients(model, features)
    source = background if background is not None else df
    means = as_value(source.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features]))
    tagged = df.withColumn("_mean", means)
    parts = {
        f"contribution_{f}": F.lit(weights[f]) * (F.col(f) - F.col(f"_mean.{f}")) for f in features
    }
    base = reduce(lambda a, f: a + F.lit(weights[f]) * F.col(f"_mean.{f}"), features, F.lit(weights[""]))
    return tagged.select(*carry, base.alias("base_value"), *[c.alias(k) for k, c in parts.items()])


def mean_contributions(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature."""
    wide = contributions.agg(*[F.avg(F.abs(f"contribution_{f}")).alias(f) for f in features])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("importance")) for f in features])
    return wide.select(F.inline(rows))
