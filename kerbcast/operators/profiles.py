"""Grouped views of demand: by hour, weekday, zone, weather and holiday."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.functions.ordered import quantiles
from kerbcast.functions.scalars import cut
from kerbcast.schemas import COUNT, PICKUP, ZONE

# Bin edges; the last one is open.
SNOW_EDGES = [-0.01, 0, 1, 5, float("inf")]
# End of fixed values. The labels are our own.
SNOW_LABELS = ["none", "trace: to 1 cm", "light: to 5 cm", "heavy: over 5 cm"]


def trips_by_zone_hour_dow(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Trips per (zone, hour, weekday) over all weeks."""
    return trips.groupBy(
        ZONE, F.hour(ts).alias("pickup_hour"), F.weekday(ts).alias("pickup_dow")
    ).agg(F.count(F.lit(1)).alias(COUNT))


def share_at_least(cells: DataFrame, floor: int = 10, column: str = COUNT) -> DataFrame:
    """Number of cells and the percentage holding at least ``floor``."""
    return cells.agg(
        F.count(F.lit(1)).alias("cells"),
        (F.avg((F.col(column) >= floor).cast("double")) * 100).alias("pct_at_least"),
    )


def cells_by_hour(cells: DataFrame) -> DataFrame:
    """Number of (zone, weekday) cells that have trips in an hour of day."""
    return cells.groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("cells"))


def trips_by_hour(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    return trips.groupBy(F.hour(ts).alias("pickup_hour")).agg(F.count(F.lit(1)).alias("trips"))


def trips_by_dow(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    return trips.groupBy(F.weekday(ts).alias("pickup_dow")).agg(F.count(F.lit(1)).alias("trips"))


def trips_dow_hour(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    """One row per weekday, one column ``h0``..``h23`` per hour; null where nothing was counted."""
    counted = trips.groupBy(
        F.weekday(ts).alias("pickup_dow"), F.hour(ts).alias("hour")
    ).agg(F.count(F.lit(1)).alias("trips"))
    return _by_hour(counted, "pickup_dow", "hour", F.sum("trips"))


def _by_hour(df: DataFrame, row: str, hour: str, measure) -> DataFrame:
    wide = df.groupBy(row).pivot(hour, list(range(24))).agg(measure)
    return wide.select(row, *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def zone_profiles(demand: DataFrame) -> DataFrame:
    """Mean count per hour of day, 24 columns per zone, 0 where the zone has no such hour."""
    wide = _by_hour(demand, ZONE, "pickup_hour", F.avg(COUNT))
    return wide.na.fill(0.0, subset=[f"h{h}" for h in range(24)])


def dow_hour_means(demand: DataFrame) -> DataFrame:
    return demand.groupBy("pickup_dow", "pickup_hour").agg(F.avg(COUNT).alias("mean_trips"))


def hour_means_of_dows(demand: DataFrame) -> DataFrame:
    """Per hour, the mean over weekdays of the weekday means (not the mean over rows)."""
    return dow_hour_means(demand).groupBy("pickup_hour").agg(F.avg("mean_trips").alias("mean_trips"))


def peak_trough(demand: DataFrame) -> DataFrame:
    """Busiest and quietest hour of day and the ratio between them; ties go to the earlier hour."""
    hours = hour_means_of_dows(demand)
    return hours.agg(
        F.max_by("pickup_hour", F.struct("mean_trips", -F.col("pickup_hour"))).alias("peak_hour"),
        F.min_by("pickup_hour", F.struct("mean_trips", "pickup_hour")).alias("trough_hour"),
        F.try_divide(F.max("mean_trips"), F.min("mean_trips")).alias("ratio"),
    )


def zone_shares(demand: DataFrame) -> DataFrame:
    """Zones by falling total with rank and cumulative share. The window runs over one row per zone."""
    totals = demand.groupBy(ZONE).agg(F.sum(COUNT).alias("total_trips"))
    ranked = Window.orderBy(F.desc("total_trips"), ZONE)
    running = ranked.rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    return totals.select(
        ZONE, "total_trips", F.row_number().over(ranked).alias("zone_rank"),
        (F.sum("total_trips").over(running) / F.sum("total_trips").over(everything))
        .alias("cumulative_share"),
    )


def zone_concentration(demand: DataFrame, tops: Sequence[int] = (10, 20)) -> DataFrame:
    """Share of all trips held by the largest zones."""
    shares = zone_shares(demand)
    held = [
        F.max(F.when(F.col("zone_rank") <= n, F.col("cumulative_share"))).alias(f"top{n}_share")
        for n in tops
    ]
    return shares.agg(F.count(F.lit(1)).alias("n_zones"), *held)


def with_snow_bucket(demand: DataFrame) -> DataFrame:
    snow = F.coalesce(F.col("snowfall"), F.lit(0.0))
    return demand.withColumn("snow_bucket", cut(snow, SNOW_EDGES, SNOW_LABELS))


def snow_effect(demand: DataFrame) -> DataFrame:
    """Mean count per snowfall bucket and its change against hours without snow."""
    stats = (
        with_snow_bucket(demand).groupBy(F.coalesce("snow_bucket", F.lit("invalid: below 0")).alias("snow_bucket"))
        .agg(F.avg(COUNT).alias("mean_trips"), F.count(F.lit(1)).alias("n_obs"))
    )
    # At most one row per bucket label reaches this window.
    dry = F.max(F.when(F.col("snow_bucket") == SNOW_LABELS[0], F.col("mean_trips")))
    return stats.withColumn(
        "vs_no_snow", F.col("mean_trips") / dry.over(Window.partitionBy()) - 1
    )


def holiday_effect(demand: DataFrame) -> DataFrame:
    """Mean, exact median and size of both groups, and the lift of holidays over other days."""
    flag = F.col("is_holiday")
    middles = quantiles(
        demand,
        {str(v): F.when(flag == v, F.col(COUNT)) for v in (0, 1)},
        [0.5],
    ).select(F.col("feature").cast("int").alias("is_holiday"), F.col("q")[0].alias("median_trips"))
    stats = demand.groupBy("is_holiday").agg(
        F.avg(COUNT).alias("mean_trips"), F.count(F.lit(1)).alias("n_obs")
    )
    usual = F.max(F.when(flag == 0, F.col("mean_trips"))).over(Window.partitionBy())
    return stats.join(middles, "is_holiday", "left").withColumn("lift", F.col("mean_trips") / usual - 1)


def holiday_by_hour(demand: DataFrame) -> DataFrame:
    wide = demand.groupBy("pickup_hour").pivot("is_holiday", [0, 1]).agg(F.avg(COUNT))
    return wide.select("pickup_hour", F.col("0").alias("ordinary_mean"), F.col("1").alias("holiday_mean"))

