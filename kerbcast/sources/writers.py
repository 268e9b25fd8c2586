"""Result tables: demand, history, predictions, model versions and runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kerbcast.schemas import COUNT, HISTORY_COLUMNS, HOUR_TS, PICKUP, ZONE

VERSION_SCHEMA = (
    "id long, trained_at timestamp_ntz, name string, mae double, mape double, "
    "n_estimators int, learning_rate double"
)
RUN_SCHEMA = T.StructType([
    T.StructField("run_name", T.StringType()), T.StructField("experiment", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def write_trip_months(trips: DataFrame, path: str, month: str | None = None) -> None:
    """One folder ``tripdata=YYYY-MM`` per month; ``month`` names a column that overrides the pickup's."""
    label = F.col(month) if month else F.date_format(PICKUP, "yyyy-MM")
    out = trips.withColumn("tripdata", label)
    if month:
        out = out.drop(month)
    out.write.mode("overwrite").partitionBy("tripdata").parquet(path)


def write_demand(demand: DataFrame, path: str) -> None:
    """The demand table by year of the hour, so that a year can be read or replaced alone."""
    demand.withColumn("year", F.year(HOUR_TS)).write.mode("overwrite").partitionBy("year").parquet(path)


def history_rows(demand: DataFrame) -> DataFrame:
    return demand.withColumnRenamed(ZONE, "zone_id").select(*HISTORY_COLUMNS)


def new_history(rows: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows whose (zone, hour) is not stored yet; of equal keys the largest count is kept."""
    keys = ["zone_id", HOUR_TS]
    # A key can repeat only as often as the weather table repeats its hour.
    best = Window.partitionBy(*keys).orderBy(F.desc(COUNT), *[c for c in HISTORY_COLUMNS if c not in keys])
    single = rows.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")
    return single if existing is None else single.join(existing.select(*keys), keys, "left_anti")


def append_history(demand: DataFrame, path: str) -> None:
    """Insert if absent: the first write of a (zone, hour) wins and a rerun adds nothing.

    History lies in folders by ``month`` of the hour; an append reads the months of its own rows only. One
    writer at a time: two appends that run together do not see each other's rows.
    """
    spark = demand.sparkSession
    rows = history_rows(demand).withColumn("month", F.date_format(HOUR_TS, "yyyy-MM"))
    # The write is computed completely before it is committed, so reading its own target is safe.
    new_history(rows, months_of(rows, path)).write.mode("append").partitionBy("month").parquet(path)


def months_of(rows: DataFrame, path: str) -> DataFrame | None:
    """What is stored of the months that occur in ``rows``; at most one value per month reaches the driver."""
    if not exists(rows.sparkSession, path):
        return None
    months = [r["month"] for r in rows.select("month").distinct().collect()]
    return rows.sparkSession.read.parquet(path).where(F.col("month").isin(months))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("month")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_rows(df: DataFrame, path: str) -> None:
    """Result tables that are rebuilt as a whole: flagged anomalies, zone clusters, baselines, margins."""
    df.write.mode("overwrite").parquet(path)


def version_row(
    spark: SparkSession, id_: int, name: str, mae: float, mape: float, trained_at: datetime,
    params: Mapping[str, float] | None = None,
) -> DataFrame:
    params = params or {}
    row = (id_, trained_at, name, mae, mape, params.get("n_estimators"), params.get("learning_rate"))
    return spark.createDataFrame([row], VERSION_SCHEMA)


def run_rows(
    metrics: DataFrame, experiment: str, features: Sequence[str], params: Mapping[str, object],
    tags: Mapping[str, str] | None = None, name: str = "model",
) -> DataFrame:
    """Run records from a frame with a model name column and numeric metric columns."""
    measures = [c for c in metrics.columns if c != name]
    as_map = lambda d: F.create_map(*[
        x for k, v in d.items() for x in (F.lit(k), F.lit(str(v)))
    ]) if d else F.create_map().cast("map<string,string>")
    all_params = {**params, **({"features": ", ".join(features)} if features else {})}
    values = F.create_map(*[x for c in measures for x in (F.lit(c), F.col(c).cast("double"))])
    return metrics.select(
        F.col(name).alias("run_name"), F.lit(experiment).alias("experiment"),
        as_map(all_params).alias("params"),
        F.map_filter(values, lambda _, v: v.isNotNull()).alias("metrics"),
        as_map(dict(tags or {})).alias("tags"),
    )


def runs_from_records(spark: SparkSession, records: Sequence[Mapping], tags: Mapping[str, str]) -> DataFrame:
    """Earlier runs given as records (run_name, experiment, params, metrics, features), for a backfill."""
    rows = []
    for r in records:
        params = {k: str(v) for k, v in r.get("params", {}).items()}
        if r.get("features"):
            params["features"] = ", ".join(r["features"])
        metrics = {k: float(v) for k, v in r.get("metrics", {}).items() if v is not None}
        rows.append((r["run_name"], r["experiment"], params, metrics, dict(tags)))
    return spark.createDataFrame(rows, RUN_SCHEMA)


def search_runs(runs: DataFrame) -> DataFrame:
    """The columns a run listing shows."""
    return runs.select(
        "run_name", F.col("metrics")["mae"].alias("mae"),
        F.col("params")["n_estimators"].alias("n_estimators"),
        F.col("params")["learning_rate"].alias("learning_rate"),
    )
