"""Row filters and derived columns on raw trips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.ordered import quantile_list
from kerbcast.functions.scalars import unit_hash
from kerbcast.functions.timeparts import minutes_between, month_start
from kerbcast.schemas import (
    DROPOFF, MAX_DISTANCE, MAX_FARE, MIN_DISTANCE, MIN_FARE, PICKUP,
)


def within_month(trips: DataFrame, year: int, month: int, ts: str = PICKUP) -> DataFrame:
    """Pickups of one month, written as a range so that it reaches the parquet scan."""
    following = (year + 1, 1) if month == 12 else (year, month + 1)
    return trips.where(
        (F.col(ts) >= month_start(year, month)) & (F.col(ts) < month_start(*following))
    )


def within_file_month(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Pickups that fall in the month their file is named after."""
    return trips.where((F.year(ts) == F.col("file_year")) & (F.month(ts) == F.col("file_month")))


def outside_file_month(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    return trips.where((F.year(ts) != F.col("file_year")) | (F.month(ts) != F.col("file_month")))


def plausible_trips(
    trips: DataFrame,
    distance: tuple[float, float] = (MIN_DISTANCE, MAX_DISTANCE),
    fare: tuple[float, float] = (MIN_FARE, MAX_FARE),
) -> DataFrame:
    """Distance and fare inside ``(low, high]``. The upper bound also removes NaN."""
    d, f = F.col("trip_distance"), F.col("fare_amount")
    return trips.where(
        (d > distance[0]) & (d <= distance[1]) & (f > fare[0]) & (f <= fare[1])
    )


def with_trip_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("trip_duration", minutes_between(F.col(PICKUP), F.col(DROPOFF)))


def clean_trips(
    trips: DataFrame, year: int | None = None, month: int | None = None, **ranges
) -> DataFrame:
    """Plausible trips with surcharges filled and the duration added.

    With a year and month, only pickups of that month; a frame that carries file columns is checked
    against each file's own month.
    """
    if year is not None and month is not None:
        trips = within_month(trips, year, month)
    if {"file_year", "file_month"} <= set(trips.columns):
        trips = within_file_month(trips)
    filled = plausible_trips(trips, **ranges).na.fill(0.0, subset=["Airport_fee", "extra"])
    return with_trip_duration(filled)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without null or NaN in the given columns."""
    return df.na.drop(subset=list(columns))


def more_trips_than(demand: DataFrame, floor: float, count: str = "trip_count") -> DataFrame:
    return demand.where(F.col(count) > floor)


def latest_year(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the newest year. The newest time is one scalar and the filter a range on the column."""
    first_day = df.agg(F.make_date(F.year(F.max(ts)), F.lit(1), F.lit(1)).cast(df.schema[ts].dataType).alias("d"))
    return df.where(F.col(ts) >= first_day.scalar())


def sample_share(df: DataFrame, share: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """A reproducible share of the rows, chosen by a hash of their key."""
    return df.where(unit_hash(*[F.col(k) for k in keys], salt=str(seed)) < share)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows in hash order: a distributed top-n, no full sort."""
    order = unit_hash(*[F.col(k) for k in keys], salt=str(seed))
    return df.orderBy(order, *keys).limit(n)


def iqr_bounds(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Quartiles and the outlier fences around them, one row. Made for raw columns."""
    spread = F.col("q3") - F.col("q1")
    return (
        df.sparkSession.range(1)
        .select(quantile_list(df, F.col(column), [0.25, 0.75], coarse_first=True).alias("q"))
        .select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
        .select("q1", "q3", (F.col("q1") - factor * spread).alias("lower"),
                (F.col("q3") + factor * spread).alias("upper"))
    )


def threshold_shares(
    df: DataFrame, tests: Mapping[str, tuple[Sequence[float], Sequence[float]]]
) -> DataFrame:
    """Share of rows inside [0, cap] and share below floor, for (caps, floors) per column.

    All thresholds of all columns come from one pass; one row each.
    """
    listed = []
    for column, (caps, floors) in tests.items():
        x = F.col(column)
        listed += [(column, "at_most", t, x.between(0, t)) for t in caps]
        listed += [(column, "below", t, x < t) for t in floors]
    wide = df.agg(*[
        F.avg(F.coalesce(inside, F.lit(False)).cast("double")).alias(f"s{i}")
        for i, (*_, inside) in enumerate(listed)
    ])
    rows = F.array(*[
        F.struct(F.lit(column).alias("measure"), F.lit(kind).alias("test"),
                 F.lit(float(t)).alias("threshold"), F.col(f"s{i}").alias("share"))
        for i, (column, kind, t, _) in enumerate(listed)
    ])
    return wide.select(F.inline(rows))
