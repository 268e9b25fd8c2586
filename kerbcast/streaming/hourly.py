"""The batch operators on streams: hourly demand, insert-if-absent history, drift per batch.

Every stream stops when the available input is used up and writes to files below the workspace, so a
restart continues from the same checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from kerbcast.functions.timeparts import epoch_hours
from kerbcast.operators.demand import hourly_demand
from kerbcast.operators.drift import feature_psi
from kerbcast.schemas import COUNT, HOUR_TS, PICKUP, ZONE
from kerbcast.session import written
from kerbcast.sources.writers import exists, months_of


def parquet_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def hourly_demand_stream(trips: DataFrame, lateness: str = "2 hours", ts: str = PICKUP) -> DataFrame:
    """Trips per zone and hour; an hour is emitted when the watermark has passed its end."""
    timed = trips.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", lateness)
    counted = timed.groupBy(F.window("_ts", "1 hour"), ZONE).agg(F.count(F.lit(1)).alias(COUNT))
    return counted.select(ZONE, F.col("window.start").cast("timestamp_ntz").alias(HOUR_TS), COUNT)


def open_hours(trips: DataFrame, lateness: str = "2 hours", ts: str = PICKUP) -> DataFrame:
    """Counts so far of the hours a stream over ``trips`` has not emitted, because trips may still arrive."""
    newest = trips.agg(F.max(ts).alias("ts")).select((F.col("ts") - F.expr(f"INTERVAL {lateness}")).alias("ts")).scalar()
    end = F.col(HOUR_TS) + F.expr("INTERVAL 1 HOUR")
    return hourly_demand(trips.where(F.col(ts) + F.expr("INTERVAL 1 HOUR") > newest), ts).where(end > newest).select(
        ZONE, HOUR_TS, COUNT)


def run_to_files(stream: DataFrame, out: str, checkpoint: str, *by: str) -> None:
    query = (
        stream.writeStream.outputMode("append").format("parquet").partitionBy(*by)
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def insert_new_cells(out: str, keys: Sequence[str] = (ZONE, HOUR_TS)) -> Callable[[DataFrame, int], None]:
    """A batch writer that adds rows whose key is not stored yet; replaying a batch adds nothing. Of equal keys
    in one batch the largest count is kept, as in the batch job."""

    def write(batch: DataFrame, _: int) -> None:
        rest = [c for c in batch.columns if c not in (*keys, COUNT)]
        best = Window.partitionBy(*keys).orderBy(F.desc(COUNT), *rest)
        rows = batch.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")
        rows = rows.withColumn("month", F.date_format(HOUR_TS, "yyyy-MM"))
        stored = months_of(rows, out)  # only the months of this batch are read
        if stored is not None:
            rows = rows.join(stored.select(*keys), list(keys), "left_anti")
        rows.write.mode("append").partitionBy("month").parquet(out)

    return write


def first_cells(cells: DataFrame, retention: str = "35 days") -> DataFrame:
    """The first row of every (zone, hour) of a stream of cells, decided by state instead of by reading the target.

    Of equal keys in one micro-batch the largest count is taken. The state is one bit per hour in a row per zone and
    day. It is dropped once that day lies more than ``retention`` behind the newest hour seen, so it holds that span, not
    the history; rows older than that are dropped by the watermark and left to ``insert_forgotten``. Rows without an hour are dropped, a null zone is a key.
    """
    keyed = cells.select(ZONE, COUNT, epoch_hours(F.col(HOUR_TS)).alias("hour")).where("hour IS NOT NULL")
    timed = keyed.withColumns({"day": F.floor(F.col("hour") / 24), "at": F.timestamp_seconds(F.col("hour") * 3600)})
    timed = timed.withWatermark("at", retention)
    zone_type = cells.schema[ZONE].dataType

    def first(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = pd.concat(list(parts)).groupby("hour", sort=True)[COUNT].max()
        seen = state.get[0] if state.exists else 0
        new = best[[not seen >> (int(h) % 24) & 1 for h in best.index]]
        if new.empty:
            return
        state.update((seen | sum(1 << (int(h) % 24) for h in new.index),))
        # Once the watermark has passed the day, no row of it arrives here.
        state.setTimeoutTimestamp(max((int(key[1]) + 1) * 86_400_000, state.getCurrentWatermarkMs() + 1))
        zone = pd.Series([None if pd.isna(key[0]) else key[0]] * len(new), dtype=object)
        yield pd.DataFrame({ZONE: zone, "hour": new.index.to_numpy(), COUNT: new.astype("Int64").to_numpy()})

    kept = timed.groupBy(ZONE, "day").applyInPandasWithState(
        first, f"{ZONE} {zone_type.simpleString()}, hour long, {COUNT} long", "seen int", "append",
        GroupStateTimeout.EventTimeTimeout)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    hour = start + F.make_dt_interval(F.floor(F.col("hour") / 24).cast("int"), F.pmod("hour", F.lit(24)).cast("int"))
    return kept.select(ZONE, hour.alias(HOUR_TS), COUNT)


def run_by_month(cells: DataFrame, out: str, checkpoint: str) -> None:
    """Append a stream of cells to ``out``/stream in folders by month of the hour, each row exactly once."""
    labelled = cells.withColumn("month", F.date_format(HOUR_TS, "yyyy-MM"))
    run_to_files(labelled, f"{out}/stream", checkpoint, "month")


def stored_cells(spark: SparkSession, out: str) -> DataFrame:
    """Everything stored below ``out`` by ``run_by_month`` and ``insert_forgotten``; raises if nothing is."""
    parts = [spark.read.parquet(path) for path in (f"{out}/stream", f"{out}/late") if exists(spark, path)]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.drop("month")


def insert_forgotten(cells: DataFrame, out: str) -> None:
    """Store the cells whose key neither the stream nor an earlier call has stored: those that came after their state
    had expired. Run it now and then over the input of a period; only the months of that input are read. Rows go to a
    folder of their own, as a stream's folder lists the stream's files only."""
    spark = cells.sparkSession
    best = cells.where(F.col(HOUR_TS).isNotNull()).groupBy(ZONE, HOUR_TS).agg(F.max(COUNT).alias(COUNT))
    rows = best.withColumn("month", F.date_format(HOUR_TS, "yyyy-MM"))
    for part in ("stream", "late"):
        stored = months_of(rows, f"{out}/{part}")
        if stored is not None:
            there = stored.select(F.col(ZONE).alias("z"), F.col(HOUR_TS).alias("h"))
            rows = rows.join(there, F.col(ZONE).eqNullSafe(F.col("z")) & (F.col(HOUR_TS) == F.col("h")), "left_anti")
    rows = written(rows, "late-cells")
    if not rows.isEmpty():  # a folder without files could not be read
        rows.write.mode("append").partitionBy("month").parquet(f"{out}/late")


def batch_drift(baseline: DataFrame, features: Sequence[str], out: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that stores the PSI of every micro-batch in a folder of its own."""

    def write(batch: DataFrame, number: int) -> None:
        psi = feature_psi(batch, baseline, features).withColumn("batch", F.lit(number))
        psi.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return write
