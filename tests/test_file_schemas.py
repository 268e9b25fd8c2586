"""Trip files whose schemas differ."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from kerbcast.sources import readers
from kerbcast.sources.file_schemas import common_type, read_united

PICKUP = pa.array([1_704_103_200_000_000], pa.int64()).cast(pa.timestamp("us"))


def trip_file(folder, month, **columns):
    base = {"tpep_pickup_datetime": PICKUP, "tpep_dropoff_datetime": PICKUP, "PULocationID": pa.array([7], pa.int64()),
            "trip_distance": pa.array([2.5]), "fare_amount": pa.array([10.0]), "Airport_fee": pa.array([1.0]),
            "extra": pa.array([0.5])} | columns
    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table({k: v for k, v in base.items() if v is not None}), folder / f"yellow_tripdata_2024-{month}.parquet")


def test_types_spelling_and_missing_columns(spark, tmp_path):
    trip_file(tmp_path / "a", "01")
    trip_file(tmp_path / "b", "02", PULocationID=pa.array([8], pa.int32()), fare_amount=pa.array([11], pa.int64()),
              Airport_fee=None, airport_fee=pa.array([2.0]))
    trip_file(tmp_path / "b", "03", extra=None, pulocationid=pa.array([9], pa.int16()), PULocationID=None,
              Airport_fee=pa.nulls(1), more=pa.array(["x"]))
    trips = readers.read_trips(spark, str(tmp_path))
    kinds = dict(trips.dtypes)
    assert kinds["PULocationID"] == "bigint" and kinds["fare_amount"] == "double" and kinds["Airport_fee"] == "double"
    assert len({c.lower() for c in trips.columns}) == len(trips.columns)
    rows = {r.file_month: r for r in trips.collect()}
    assert [rows[m].PULocationID for m in (1, 2, 3)] == [7, 8, 9]
    assert [rows[m].Airport_fee for m in (1, 2, 3)] == [1.0, 2.0, None]
    assert [rows[m].extra for m in (1, 2, 3)] == [0.5, 0.5, None] and [rows[m].more for m in (1, 2, 3)] == [None, None, "x"]
    cleaned = readers.load_clean_trips(spark, str(tmp_path), 2024, 1)
    assert [(r.PULocationID, r.trip_duration) for r in cleaned.collect()] == [(7, 0.0)]


def test_a_missing_required_column_names_its_file(spark, tmp_path):
    trip_file(tmp_path / "a", "01")
    trip_file(tmp_path / "a", "02", fare_amount=None)
    with pytest.raises(ValueError, match="tripdata_2024-02.parquet has no column fare_amount"):
        readers.read_trips(spark, str(tmp_path))
    assert readers.read_trips(spark, str(tmp_path), 2024, 1).count() == 1


def test_unreadable_files(spark, tmp_path):
    trip_file(tmp_path / "a", "01")
    (tmp_path / "a" / "yellow_tripdata_2024-02.parquet").write_bytes(b"no parquet")
    with pytest.raises(ValueError, match="tripdata_2024-02"):
        readers.read_trips(spark, str(tmp_path))
    assert readers.read_trips(spark, str(tmp_path), skip_corrupt=True).count() == 1
    with pytest.raises(ValueError, match="none of 1"):
        read_united(spark, [str(tmp_path / "a" / "yellow_tripdata_2024-02.parquet")], skip_corrupt=True)


def test_equal_schemas_are_one_scan(spark, tmp_path):
    for month in ("01", "02", "03"):
        trip_file(tmp_path / "a", month)
    plan = readers.read_trips(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_common_types():
    assert common_type([T.IntegerType(), T.LongType(), T.ShortType()]) == T.LongType()
    assert common_type([T.IntegerType(), T.FloatType()]) == T.DoubleType()
    assert common_type([T.TimestampType(), T.TimestampNTZType()]) == T.TimestampNTZType()
    assert common_type([T.StringType(), T.LongType()]) == T.StringType()
