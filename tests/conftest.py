import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from kerbcast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "kerbcast-tests", master="local[8]", spark__sql__shuffle__partitions=4, spark__driver__memory="6g",
        spark__sql__maxMetadataStringLength=10000,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def hourly(spark):
    """``make(zones, hours, count)``: one row per zone and hour with a count function of both."""

    def make(zones, hours, count, start=datetime(2024, 1, 1)):
        rows = [
            (z, start + timedelta(hours=h), int(count(z, h)), (start + timedelta(hours=h)).hour,
             (start + timedelta(hours=h)).weekday())
            for z in zones for h in range(hours)
        ]
        schema = ("PULocationID int, pickup_hour_ts timestamp_ntz, trip_count long, "
                  "pickup_hour int, pickup_dow int")
        return spark.createDataFrame(rows, schema)

    return make
