"""Labels, weights and evaluation of classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.ordered import quantile, running_totals
from kerbcast.functions.scalars import as_value
from kerbcast.schemas import COUNT, ZONE


def with_high_demand(df: DataFrame, prob: float = 0.75, count: str = COUNT, name: str = "high_demand") -> DataFrame:
    """1 where the count reaches the quantile of the whole frame. Label first, split afterwards."""
    return df.withColumn(name, (F.col(count) >= quantile(df, F.col(count), prob)).cast("int"))


def with_sample_weight(train: DataFrame, peak: float = 0.8, name: str = "sample_weight") -> DataFrame:
    """Peak rows count double, zones inversely to their mean demand; the weights average 1."""
    zone_means = train.groupBy(ZONE).agg(
        F.avg(COUNT).alias("_zone_mean"), F.sum(COUNT).alias("_s"), F.count(F.lit(1)).alias("_n")
    )
    # Averages over rows, taken from the zone table: every row of a zone has the same zone mean.
    overall = zone_means.agg((F.sum("_s") / F.sum("_n")).alias("row_mean")).scalar()
    inverse = zone_means.select(
        ZONE, "_n", (1.0 / (F.col("_zone_mean") / overall + 0.1)).alias("_inverse")
    )
    inverse_mean = inverse.agg((F.sum(F.col("_inverse") * F.col("_n")) / F.sum("_n")).alias("m")).scalar()
    factors = inverse.select(ZONE, (F.col("_inverse") / inverse_mean).alias("_factor"))
    double = F.when(F.col(COUNT) >= quantile(train, F.col(COUNT), peak), 2.0).otherwise(1.0)
    combined = train.join(factors, ZONE, "left").withColumn("_weight", double * F.col("_factor"))
    mean_weight = combined.agg(F.avg("_weight").alias("m")).scalar()
    return combined.withColumn(name, F.col("_weight") / mean_weight).drop("_factor", "_weight")


def balanced_class_weight(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """rows / (classes * rows of the class), for a 0/1 label."""
    n = as_value(df.agg(
        F.count(F.lit(1)).cast("double").alias("all"), F.sum(label).cast("double").alias("ones")
    ))
    ones = F.col("_n.ones")
    weight = F.when(F.col(label) == 1, F.try_divide(F.col("_n.all"), 2 * ones)).otherwise(
        F.try_divide(F.col("_n.all"), 2 * (F.col("_n.all") - ones))
    )
    return df.withColumn("_n", n).withColumn(name, weight).drop("_n")


def ranking_metrics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """ROC-AUC and average precision, ties handled exactly.

    Works on distinct scores with running totals computed piecewise, so no task sorts all rows.
    """
    totals = running_totals(
        scored, {"score": F.col(score)}, {"pos": F.col(label).cast("long")}
    )
    pos_above = F.col("pos_total") - F.col("pos_upto")
    pos_from = pos_above + F.col("pos")
    n_from = F.col("n_total") - F.col("n_upto") + F.col("n")
    neg = F.col("n") - F.col("pos")
    return totals.agg(
        F.try_divide(
            F.sum(neg * (pos_above + F.col("pos") / 2.0)),
            F.max(F.col("pos_total") * (F.col("n_total") - F.col("pos_total"))),
        ).alias("roc_auc"),
        F.sum(F.try_divide(F.col("pos"), F.col("pos_total")) * pos_from / n_from).alias("average_precision"),
    )


def class_report(scored: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of both classes from one aggregate."""
    y, p = F.col(label), F.col(predicted)
    count = lambda cond: F.count_if(cond)
    wide = scored.agg(*[
        c for k in (0, 1) for c in (
            count((y == k) & (p == k)).alias(f"tp{k}"), count((y != k) & (p == k)).alias(f"fp{k}"),
            count((y == k) & (p != k)).alias(f"fn{k}"),
        )
    ])

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))

    rows = F.array(*[
        F.struct(
            F.lit(name).alias("class"),
            ratio(F.col(f"tp{k}"), F.col(f"tp{k}") + F.col(f"fp{k}")).alias("precision"),
            ratio(F.col(f"tp{k}"), F.col(f"tp{k}") + F.col(f"fn{k}")).alias("recall"),
            ratio(2 * F.col(f"tp{k}"), 2 * F.col(f"tp{k}") + F.col(f"fp{k}") + F.col(f"fn{k}")).alias("f1"),
            (F.col(f"tp{k}") + F.col(f"fn{k}")).alias("support"),
        )
        for k, name in ((0, "normal"), (1, "high_demand"))
    ])
    return wide.select(F.inline(rows))


def label_rates(df: DataFrame, label: str = "high_demand", split: str = "split") -> DataFrame:
    """Rows and share of positives per part of a split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("rate")
    )
