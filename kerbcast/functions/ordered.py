"""Exact order statistics without sorting a whole column in one task.

A column is first reduced to distinct values with their totals (partial aggregation runs before the
shuffle, so a hot value costs nothing). Split points are chosen among the distinct values by hash, which
is reproducible and uniform; they only decide where the ordered values are cut into pieces, never which
rows count. Piece totals give every piece its starting rank,
and the running sums are windows inside one piece. There are at most ``pieces`` split points and starting
ranks per column, so the broadcasts that carry them to the values have a fixed size.

For a few quantiles of a raw column with mostly different values, even the distinct values are too many
to shuffle. ``coarse_first`` then counts rows per coarse interval (a handful of numbers per task), finds
the intervals that hold the wanted ranks, and treats only their rows as above.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.session import written

# Pieces limit the parallelism of sorting a column with very many distinct values; raise them with it.
PIECES = 512


def _long(
    df: DataFrame, columns: Mapping[str, Column], measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """One (feature, value, measures...) row per column and input row; null and NaN left out."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("feature"), col.cast("double").alias("value"))
        for name, col in columns.items()
    ])
    extra = [c.alias(m) for m, c in (measures or {}).items()]
    long = df.select(F.inline(pairs), *extra)
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def _totals(long: DataFrame, measures: Sequence[str] = ()) -> DataFrame:
    return long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in measures]
    )


def _coarse(value: Column) -> Column:
    """An integer that never falls as the value rises: the signed eighth root in steps of 1/4096.

    Square roots are correctly rounded everywhere, so two passes agree on every row. Up to 2**20
    intervals on either side; larger values share the outermost one.
    """
    root = F.sqrt(F.sqrt(F.sqrt(F.abs(value))))
    step = F.least(F.floor(root * 4096.0), F.lit(2**20)).cast("long")
    return F.when(value < 0, -step - 1).otherwise(step)


def _ranks(probs: Sequence[float], total: Column) -> list[Column]:
    spots = [F.lit(float(p)) * (total - 1) for p in probs]
    return [rank for s in spots for rank in (F.floor(s), F.ceil(s))]


def _holds_any(ranks: Sequence[Column], start: Column, size: Column) -> Column:
    held = F.lit(False)
    for rank in ranks:
        held = held | ((rank >= start) & (rank < start + size))
    return held


def _near_ranks(long: DataFrame, probs: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """Rows of the coarse intervals holding a wanted rank, and (feature, interval, skipped, total).

    ``skipped`` counts the dropped rows before an interval. At most two intervals per quantile remain. Both
    results are written, so that the source is read twice in all, whatever is done with them.
    """
    tagged = long.withColumn("interval", _coarse(F.col("value")))
    counts = tagged.groupBy("feature", "interval").agg(F.count(F.lit(1)).alias("m"))
    in_order = Window.partitionBy("feature").orderBy("interval")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        "feature", "interval", "m",
        F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"),
        F.sum("m").over(Window.partitionBy("feature")).alias("all_rows"),
    )
    held = placed.where(_holds_any(_ranks(probs, F.col("all_rows")), F.col("start"), F.col("m")))
    kept_before = F.coalesce(F.sum("m").over(before), F.lit(0))
    held = written(
        held.select("feature", "interval", "all_rows", (F.col("start") - kept_before).alias("skipped")), "intervals")
    rows = tagged.join(F.broadcast(held.select("feature", "interval")), ["feature", "interval"], "left_semi")
    return written(rows.select(*long.columns), "near-ranks"), held


def _with_piece(totals: DataFrame, long: DataFrame, pieces: int) -> DataFrame:
    """The totals with their ``piece``, 0 to ``pieces``, rising with the value.

    Split points are one value per hash class, the one with the smallest second hash: a uniform choice
    among the distinct values that partial aggregation makes without sorting or shuffling rows.
    """
    points = (
        long.groupBy("feature", F.pmod(F.xxhash64("value"), F.lit(pieces)).alias("class"))
        .agg(F.min_by("value", F.xxhash64("value", F.lit(1))).alias("point"))
        .groupBy("feature").agg(F.array_sort(F.collect_list("point")).alias("points"))
    )
    # Two short searches instead of one long one: first among every width-th point, then in its block.
    width = max(1, round(pieces**0.5))
    starts = F.sequence(F.lit(0), F.lit((pieces - 1) // width))
    blocks = points.select(
        "feature",
        F.filter("points", lambda _, i: i % width == 0).alias("heads"),
        F.transform(starts, lambda i: F.slice("points", i * width + 1, width)).alias("blocks"),
    )
    reached = F.size(F.filter("heads", lambda p: p <= F.col("value")))
    block = F.try_element_at("blocks", F.nullif(reached, F.lit(0)))
    inside = F.coalesce(F.size(F.filter(block, lambda p: p <= F.col("value"))), F.lit(0))
    return totals.join(F.broadcast(blocks), "feature").select(
        *totals.columns, (F.greatest(reached - 1, F.lit(0)) * width + inside).alias("piece")
    )


def _piece_sums(cut: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Per piece the sums before it, in it and over all; at most ``pieces + 1`` rows per feature."""
    in_order = Window.partitionBy("feature").orderBy("piece")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    # The largest value is taken along so that this branch reads the same shuffled columns as the rows.
    return (
        cut.groupBy("feature", "piece").agg(F.max("value").alias("top"), *[F.sum(s).alias(s) for s in sums])
        .where(F.col("top").isNotNull())
        .select(
            "feature", "piece",
            *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_before") for s in sums],
            *[F.col(s).alias(f"{s}_piece") for s in sums],
            *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
        )
    )


def running_totals(
    df: DataFrame, columns: Mapping[str, Column],
    measures: Mapping[str, Column] | None = None, pieces: int = PIECES,
) -> DataFrame:
    """Per distinct value: its totals, ``*_upto`` (values up to and including it) and ``*_total``."""
    return running_totals_of(_long(df, columns, measures), list(measures or {}), pieces)


def running_totals_of(long: DataFrame, measures: Sequence[str] = (), pieces: int = PIECES) -> DataFrame:
    """The same of rows that already are (feature, value, measures...), free of null and NaN."""
    sums = ["n", *measures]
    # The distinct values are written: split points come from them, not from another read of the source.
    totals = written(_totals(long, sums[1:]), "distinct-values")
    cut = _with_piece(totals, totals, pieces).repartition("feature", "piece")
    bases = _piece_sums(cut, sums)
    inside = (
        Window.partitionBy("feature", "piece").orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return cut.join(F.broadcast(bases), ["feature", "piece"]).select(
        "feature", "value", *sums,
        *[(F.col(f"{s}_before") + F.sum(s).over(inside)).alias(f"{s}_upto") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
    )


def quantiles(
    df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], pieces: int = PIECES,
    coarse_first: bool = False,
) -> DataFrame:
    """(feature, n, q): exact linear-interpolation quantiles, ``q`` in the order of ``probs``.

    Only pieces holding a wanted rank are sorted. Features without values are absent.
    """
    long = _long(df, columns)
    held = None
    if coarse_first:
        long, held = _near_ranks(long, probs)
    cut = _with_piece(_totals(long), long, pieces)
    bases = _piece_sums(cut, ["n"])
    value, start, size = F.col("value"), F.col("n_before"), F.col("n_piece")
    if held is None:
        bases = bases.withColumn("all_rows", F.col("n_total"))
        bases = bases.where(_holds_any(_ranks(probs, F.col("all_rows")), start, size))
        joined = cut.join(F.broadcast(bases), ["feature", "piece"]).withColumn("skipped", F.lit(0))
    else:
        cut = cut.withColumn("interval", _coarse(value))
        joined = cut.join(F.broadcast(bases), ["feature", "piece"])
        joined = joined.join(F.broadcast(held), ["feature", "interval"])
    inside = (
        Window.partitionBy("feature", "piece").orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = joined.select(
        "feature", "value", "n", "all_rows",
        (F.col("skipped") + start + F.sum("n").over(inside)).alias("stop"),
    )

    def at(rank: Column) -> Column:
        here = (rank >= F.col("stop") - F.col("n")) & (rank < F.col("stop"))
        return F.max(F.when(here, value))

    ranks = _ranks(probs, F.col("all_rows"))
    found = placed.groupBy("feature").agg(
        F.max("all_rows").alias("all_rows"), *[at(r).alias(f"at{i}") for i, r in enumerate(ranks)]
    )
    values = []
    for i, p in enumerate(probs):
        spot = F.lit(float(p)) * (F.col("all_rows") - 1)
        low, high = F.col(f"at{2 * i}"), F.col(f"at{2 * i + 1}")
        values.append(low + (high - low) * (spot - F.floor(spot)))
    return found.select("feature", F.col("all_rows").alias("n"), F.array(*values).alias("q"))


def quantile(df: DataFrame, column: Column, prob: float, coarse_first: bool = False) -> Column:
    """One exact quantile as a scalar subquery."""
    found = quantiles(df, {"x": column}, [prob], coarse_first=coarse_first)
    return found.select(F.col("q")[0].alias("q")).scalar()


def quantile_list(
    df: DataFrame, column: Column, probs: Sequence[float], coarse_first: bool = False
) -> Column:
    """Several exact quantiles of one column as a scalar subquery holding an array."""
    return quantiles(df, {"x": column}, probs, coarse_first=coarse_first).select("q").scalar()
