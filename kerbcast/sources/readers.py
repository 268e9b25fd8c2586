"""Readers for landed files: trips by month, hourly weather, public holidays, the demand table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from kerbcast.operators.cleaning import clean_trips, within_month
from kerbcast.schemas import HOUR_TS, PICKUP, TRIP_COLUMNS, TRIP_EXTRAS, WEATHER
from kerbcast.sources.file_schemas import read_united

# The year and month in the name of a trip file, or of the folder a Spark job wrote for that month.
FILE_MONTH = r"tripdata[_=](\d{4})-(\d{2})"
WEATHER_JSON = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, "
    "precipitation: array<double>, snowfall: array<double>>"
)
HOLIDAY_JSON = "date string, name string"


def file_month(part: int) -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), FILE_MONTH, part).cast("int")


def trip_paths(spark: SparkSession, path: str, year: int | None = None, month: int | None = None) -> list[str]:
    """Files named after a month, and folders a Spark job wrote for one, anywhere below ``path``.

    Only names are listed; the list has one entry per such file or folder.
    """
    y = f"{year:04d}" if year is not None else r"\d{4}"
    m = f"{month:02d}" if month is not None else r"\d{2}"
    named = rf"^(.*?/[^/]*tripdata[_=]{y}-{m}[^/]*)(?:/|$)"
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException:
        return []
    found = listed.select(F.regexp_extract("path", named, 1).alias("path")).where("path <> ''").distinct()
    return sorted(r["path"] for r in found.collect())


def read_trips(
    spark: SparkSession, path: str, year: int | None = None, month: int | None = None,
    skip_corrupt: bool = False, schema: StructType | None = None,
) -> DataFrame:
    """All trip files below ``path``, at any depth, with ``file_year`` and ``file_month``.

    Files are chosen by their listed names, so others are never opened. Raises if nothing matches. Files may differ
    in types, spelling and columns; see ``file_schemas.read_united``. A file without a required column raises and is
    named. Unreadable files fail the job unless ``skip_corrupt`` is set. With a ``schema``, all files are read by it.
    """
    files = trip_paths(spark, path, year, month)
    if not files:
        raise ValueError(f"{path} holds no trip file of year {year or 'any'} and month {month or 'any'}")
    months = {"file_year": file_month(1), "file_month": file_month(2)}
    if schema is None:
        return read_united(spark, files, TRIP_COLUMNS, TRIP_EXTRAS, skip_corrupt, months)
    reader = spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", skip_corrupt)
    return reader.schema(schema).parquet(*files).withColumns(months)


def load_clean_trips(
    spark: SparkSession, path: str, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Read and clean; with both year and month the time range also reaches the parquet scan."""
    trips = read_trips(spark, path, year, month)
    if year is not None and month is not None:
        trips = within_month(trips, year, month)
    return clean_trips(trips)


def file_completeness(
    trips: DataFrame, ts: str = PICKUP, expected: Sequence[tuple[int, int]] | None = None
) -> DataFrame:
    """Per file month: the newest pickup, and whether it reaches the last day of that month.

    ``expected`` lists (year, month) pairs that must appear: a month without a readable file is
    incomplete. Only the time column is read, and one row per month leaves each task.
    """
    months = trips.groupBy("file_year", "file_month").agg(F.max(ts).alias("last_pickup"))
    if expected is not None:
        wanted = trips.sparkSession.createDataFrame(list(expected), "file_year int, file_month int")
        months = wanted.join(months, ["file_year", "file_month"], "left")
    last = F.last_day(F.make_date("file_year", "file_month", F.lit(1)))
    return months.withColumn("complete", F.coalesce(F.to_date("last_pickup") >= last, F.lit(False)))


def clean_weather(raw: DataFrame) -> DataFrame:
    """``time`` text as a naive hour."""
    return raw.select(F.to_timestamp_ntz(F.col("time")).alias(HOUR_TS), *WEATHER)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return clean_weather(spark.read.option("recursiveFileLookup", True).parquet(path))


def read_weather_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Columnar weather documents, ``{"hourly": {"time": [...], ...}}``, as one row per hour."""
    docs = spark.read.schema(WEATHER_JSON).option("multiLine", multi_line).json(path)
    columns = [F.col(f"hourly.{c}") for c in ("time", *WEATHER)]
    hours = docs.select(F.inline(F.arrays_zip(*columns))).toDF("time", *WEATHER)
    return clean_weather(hours)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Holiday parquet files, one per year, as (date, name); dates may be stored as text."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    return rows.select(F.to_date("date").alias("date"), "name")


def read_holidays_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Arrays of holiday objects as (date, name); other fields are not parsed."""
    rows = spark.read.schema(HOLIDAY_JSON).option("multiLine", multi_line).json(path)
    return rows.select(F.to_date("date").alias("date"), "name")


def holiday_dates(holidays: DataFrame) -> DataFrame:
    return holidays.select("date").distinct()


def read_demand(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
