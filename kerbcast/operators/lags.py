"""History features per zone.

A demand row is one zone and one hour, so a zone never has more rows than the data has hours (8,784 a
year), whatever the number of trips behind them. Windows over a zone are therefore bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbcast.functions.timeparts import plus_hours
from kerbcast.schemas import COUNT, HOUR_TS, SEQUENCE_FEATURES, ZONE


def _in_time(zone: str = ZONE, ts: str = HOUR_TS) -> Window:
    return Window.partitionBy(zone).orderBy(ts)


def row_lags(demand: DataFrame, lags: Sequence[int] = (24, 168), keep_incomplete: bool = False) -> DataFrame:
    """Trip counts the given number of *rows* earlier in the zone; rows lacking any are dropped."""
    names = {f"lag_{n}h": F.lag(COUNT, n).over(_in_time()).cast("double") for n in lags}
    lagged = demand.withColumns(names)
    return lagged if keep_incomplete else lagged.na.drop(subset=list(names))


def time_lags(
    points: DataFrame, history: DataFrame, lags: Sequence[int] = (24, 168), default: float | None = 0.0,
    ts: str = HOUR_TS, zone: str = ZONE, history_zone: str = ZONE,
) -> DataFrame:
    """Trip counts exactly the given number of *hours* earlier, ``default`` where there is no such row.

    Equi joins on (zone, hour): the points are shuffled once for all lags and a busy zone is spread.
    """
    out = points
    for n in lags:
        past = history.select(
            F.col(history_zone).alias("_zone"),
            plus_hours(F.col(HOUR_TS), n).alias("_ts"),
            F.col(COUNT).cast("double").alias("_count"),
        )
        match = (F.col(zone) == F.col("_zone")) & (F.col(ts) == F.col("_ts"))
        found = F.col("_count") if default is None else F.coalesce("_count", F.lit(float(default)))
        out = out.join(past, match, "left").withColumn(f"lag_{n}h", found)
        out = out.drop("_zone", "_ts", "_count")
    return out


def autocorrelation(
    demand: DataFrame, lags: Sequence[int] = (1, 2, 6, 12, 24, 48, 72, 168), every_zone: bool = False, chunk: int = 8192
) -> DataFrame:
    """Pearson r of a zone's counts and its counts some rows earlier; by default for the busiest zone.

    Null where either side does not vary. Sums are exact for whole counts.
    """
    series = demand.select(ZONE, HOUR_TS, F.col(COUNT).cast("double").alias("y"))
    if not every_zone:
        totals = demand.groupBy(ZONE).agg(F.sum(COUNT).alias("total"))
        top = totals.agg(F.max_by(ZONE, F.struct("total", -F.col(ZONE))).alias(ZONE))
        series = series.where(F.col(ZONE) == top.scalar())
    # Rows are numbered once and cut into chunks; a chunk also gets the rows its first ones look back to, so that all
    # lags are summed where a chunk lies and no row is copied per lag. Values are taken from the zone's first one.
    reach = max(lags, default=0)
    size = max(chunk, reach, 1)
    in_time = _in_time()
    numbered = series.select(
        ZONE, (F.col("y") - F.first("y", ignorenulls=True).over(in_time.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("y"),
        (F.row_number().over(in_time) - 1).cast("long").alias("n"))
    own, last = F.col("n") / size, F.max("n").over(Window.partitionBy(ZONE))
    following = F.when(F.col("n") % size >= size - reach, F.floor(own) + 1)
    dealt = numbered.withColumn("last", F.floor(last / size)).withColumn(
        "chunk", F.explode(F.array_compact(F.array(F.floor(own), following)))).where("chunk <= last")

    def summed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        zone, part = key
        start = int(part) * size
        first = int(group["n"].min())
        y = np.full(int(group["n"].max()) - first + 1, np.nan)
        y[group["n"].to_numpy() - first] = group["y"].to_numpy(dtype=float, na_value=np.nan)
        rows = []
        for lag in lags:
            here = np.arange(max(start, first + lag), first + len(y)) - first
            x, z = y[here], y[here - lag]
            both = ~(np.isnan(x) | np.isnan(z))
            x, z = x[both], z[both]
            rows.append((zone, lag, len(x), x.sum(), z.sum(), x @ x, z @ z, x @ z))
        return pd.DataFrame(rows, columns=[ZONE, "lag", "m", "sx", "sz", "sxx", "szz", "sxz"])

    kind = demand.schema[ZONE].dataType.simpleString()
    sums = dealt.groupBy(ZONE, "chunk").applyInPandas(
        summed, f"{ZONE} {kind}, lag int, m long, sx double, sz double, sxx double, szz double, sxz double")
    m, sx, sz, sxx, szz, sxz = (F.sum(c) for c in ("m", "sx", "sz", "sxx", "szz", "sxz"))
    spread = F.sqrt(m * sxx - sx * sx) * F.sqrt(m * szz - sz * sz)
    return sums.groupBy(ZONE, "lag").agg(F.try_divide(m * sxz - sx * sz, spread).alias("r"))


def sequence_windows(
    demand: DataFrame, window: int = 24, ratio: float = 0.8,
    features: Sequence[str] = tuple(SEQUENCE_FEATURES), carry: Sequence[str] = (),
) -> DataFrame:
    """The ``window`` rows before each target row, and the part of the split the target belongs to.

    Per zone the cut is at ``floor(rows * ratio)``: train targets end before it, test targets start one
    window after it so that no test history reaches into the training rows.
    """
    past = _in_time().rowsBetween(-window, -1)
    row, size = F.row_number().over(_in_time()) - 1, F.count(F.lit(1)).over(Window.partitionBy(ZONE))
    framed = demand.select(
        ZONE, HOUR_TS, F.col(COUNT).cast("double").alias("target"), *carry,
        F.collect_list(F.struct(*features)).over(past).alias("history"),
        row.alias("row"), F.floor(size * F.lit(float(ratio))).alias("cut"),
    )
    part = (
        F.when((F.col("row") >= window) & (F.col("row") < F.col("cut")), "train")
        .when(F.col("row") >= F.col("cut") + window, "test")
    )
    return framed.withColumn("split", part).where(F.col("split").isNotNull()).drop("row", "cut")


def latest_history(history: DataFrame, n: int = 24, zone: str = "zone_id") -> DataFrame:
    """The newest ``n`` rows of every zone that has that many, with ``step`` 1..n in time order.

    The row limit is applied before the shuffle as well as after it.
    """
    newest = Window.partitionBy(zone).orderBy(F.desc(HOUR_TS))
    last = history.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= n)
    full = last.withColumn("have", F.count(F.lit(1)).over(Window.partitionBy(zone)))
    return full.where(F.col("have") == n).withColumn("step", n + 1 - F.col("back")).drop("back", "have")


def zones_short_of_history(history: DataFrame, n: int = 24, zone: str = "zone_id") -> DataFrame:
    """Zones that cannot be scored from a sequence, with the number of rows they have."""
    return history.groupBy(zone).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") < n)
