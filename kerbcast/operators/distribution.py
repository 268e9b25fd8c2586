"""Distribution of single columns and dependence between columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.functions.ordered import quantiles, running_totals
from kerbcast.functions.scalars import as_value, clean_number, correlation

QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, columns: Sequence[str], coarse_first: bool = False) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles; one row per column.

    ``coarse_first`` suits raw tables, see ``ordered.quantiles``.
    """
    parts = []
    for i, c in enumerate(columns):
        x = clean_number(F.col(c))
        parts += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
        ]
    names = {"n": "count", "mean": "mean", "std": "std", "min": "min", "max": "max"}
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{k}{i}").alias(v) for k, v in names.items()])
        for i, c in enumerate(columns)
    ])
    moments = df.agg(*parts).select(F.inline(rows))
    middle = quantiles(df, {c: F.col(c) for c in columns}, QUARTILES, coarse_first=coarse_first)
    q = [F.col("q")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    return moments.join(middle.select("feature", *q), "feature", "left")


def shape(df: DataFrame, column: str) -> DataFrame:
    """Sample-corrected skewness and excess kurtosis, and the share of zeros."""
    x = clean_number(F.col(column))
    base = df.agg(
        F.count(x).alias("n"), F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"),
        F.avg((x == 0).cast("double")).alias("zero_share"),
    )
    n, g1, g2 = F.col("n").cast("double"), F.col("g1"), F.col("g2")
    skew = F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    kurt = F.when(
        n > 3,
        (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * g2 + 6),
    )
    return base.select(skew.alias("skewness"), kurt.alias("kurtosis"), "zero_share")


def histogram(df: DataFrame, value: Column, bins: int = 80) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included; the last bin is closed."""
    data = df.select(value.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = as_value(data.agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    placed = data.withColumn("ends", ends)
    width = F.col("ends.hi") - F.col("ends.lo")
    spot = F.floor((F.col("x") - F.col("ends.lo")) / F.nullif(width, F.lit(0.0)) * bins)
    counted = (
        placed.select(F.least(F.coalesce(spot, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        grid.join(counted, "bin", "left").withColumn("ends", ends)
        .select(
            "bin",
            (F.col("ends.lo") + F.col("bin") * (F.col("ends.hi") - F.col("ends.lo")) / bins).alias("left_edge"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def ecdf(df: DataFrame, column: str) -> DataFrame:
    """P(X <= x) at every distinct value."""
    totals = running_totals(df, {column: F.col(column)})
    return totals.select("value", "n", (F.col("n_upto") / F.col("n_total")).alias("cdf"))


def _pairwise(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson r of each column pair, nulls as 0, all from one aggregate; null for a constant column."""
    columns = sorted({c for pair in pairs for c in pair})
    filled = df.select(*[F.coalesce(clean_number(F.col(c)), F.lit(0.0)).alias(c) for c in columns])
    wide = filled.agg(*[
        correlation(F.col(a), F.col(b), complete=True).alias(f"r{i}") for i, (a, b) in enumerate(pairs)
    ])
    rows = F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ])
    return wide.select(F.inline(rows))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle of the correlation matrix in long form."""
    return _pairwise(df, [(a, b) for i, a in enumerate(columns) for b in columns[:i]])


def correlation_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Correlations with one column, strongest first."""
    found = _pairwise(df, [(c, target) for c in columns])
    return found.select(F.col("x").alias("feature"), "r", F.abs("r").alias("abs_r")).orderBy(
        F.desc_nulls_last("abs_r"), "feature"
    )


def profile(df: DataFrame, ts: str, distinct: Sequence[str], nullable: Sequence[str]) -> DataFrame:
    """Rows, time range, exact distinct counts and null counts in one row, from one scan.

    The distinct columns are identifiers of bounded range: the rows are first reduced to one per
    combination of them, and the distinct counts are taken from that small table.
    """
    null_count = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in nullable}
    combined = df.groupBy(*distinct).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        *[c.alias(name) for name, c in null_count.items()],
    )
    return combined.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in null_count],
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in distinct],
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) for every column, from one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_null")) for i, c in enumerate(df.columns)
    ])
    return wide.select(F.inline(rows))


def mutual_information(
    df: DataFrame, features: Sequence[str], target: str, bins: int = 10
) -> DataFrame:
    """Binned mutual information of each feature with the target, highest first.

    Values are binned at their own quantiles (ties stay together), nulls count as 0. Cell counts are
    at most ``bins``² per feature, so everything after the first aggregate is small.
    """
    columns = [*features, target]
    filled = df.select(*[F.coalesce(clean_number(F.col(c)), F.lit(0.0)).alias(c) for c in columns])
    probs = [i / bins for i in range(1, bins)]
    edges = quantiles(filled, {c: F.col(c) for c in columns}, probs).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "q"))).alias("edges")
    )
    tagged = filled.withColumn("edges", edges.scalar())

    def bin_of(c: str) -> Column:
        return F.size(F.filter(F.element_at("edges", F.lit(c)), lambda e: e < F.col(c)))

    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), bin_of(c).alias("bx")) for c in features])
    cells = (
        tagged.select(bin_of(target).alias("by"), F.inline(pairs))
        .groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).alias("nxy"))
    )
    return _information(cells)


def _information(cells: DataFrame) -> DataFrame:
    total = lambda *keys: F.sum("nxy").over(Window.partitionBy(*keys))
    parts = cells.select(
        "feature", "nxy", total("feature", "bx").alias("nx"), total("feature", "by").alias("ny"),
        total("feature").alias("n"),
    )
    p = F.col("nxy") / F.col("n")
    term = p * F.log(p / ((F.col("nx") / F.col("n")) * (F.col("ny") / F.col("n"))))
    return parts.groupBy("feature").agg(F.sum(term).alias("mutual_information"))


def standardize(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "_z"
) -> DataFrame:
    """Zero mean and unit *population* deviation, a constant column only centred."""
    base = fit_on if fit_on is not None else df
    parts = []
    for c in columns:
        parts += [F.avg(F.col(c).cast("double")).alias(f"{c}_m"), F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_s")]
    stats = as_value(base.agg(*parts))
    scaled: Mapping[str, Column] = {
        f"{c}{suffix}": (F.col(c) - F.col(f"_fit.{c}_m"))
        / F.when(F.col(f"_fit.{c}_s") == 0, 1.0).otherwise(F.col(f"_fit.{c}_s"))
        for c in columns
    }
    return df.withColumn("_fit", stats).withColumns(scaled).drop("_fit")
