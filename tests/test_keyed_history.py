"""Insert if absent by keyed state: equal to the batch job, over restarts and late rows."""

from datetime import datetime, timedelta

import pytest

from kerbcast.streaming import hourly as streams

SCHEMA = "PULocationID int, pickup_hour_ts timestamp_ntz, trip_count long"
START = datetime(2024, 3, 10)


def at(hours):
    return START + timedelta(hours=hours)


@pytest.fixture
def run(spark, tmp_path):
    """Writes each list of (zone, hour, count) as one file and runs the stream over what is new."""
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def step(*files, retention="2 days"):
        for rows in files:
            df = spark.createDataFrame([(z, at(h), n) for z, h, n in rows], SCHEMA)
            df.coalesce(1).write.mode("append").parquet(source)
        cells = streams.parquet_stream(spark, source, df.schema, files_per_batch=1)
        streams.run_by_month(streams.first_cells(cells, retention), out, state)
        return {(r.PULocationID, r.pickup_hour_ts): r.trip_count for r in streams.stored_cells(spark, out).collect()}

    step.source, step.out = source, out
    return step


def test_first_row_wins_over_batches_and_restarts(spark, run):
    first = run([(1, 0, 3), (1, 0, 9), (2, 0, 4), (None, 0, 5)], [(1, 0, 50), (1, 1, 6)])
    assert first == {(1, at(0)): 9, (2, at(0)): 4, (None, at(0)): 5, (1, at(1)): 6}
    again = run([(1, 0, 70), (2, 1, 8), (None, 0, 1)])       # another run from the same checkpoint
    assert again == {**first, (2, at(1)): 8}
    assert streams.stored_cells(spark, run.out).count() == len(again)


def test_expired_keys_and_late_rows_end_like_the_batch(spark, run):
    got = run([(1, 0, 3)], [(1, 100, 4)], [(1, 101, 5)], [(1, 0, 77), (2, 1, 6), (1, 99, 2)])
    # Hour 0 is behind the watermark: its state is gone, its repetition and the late cell of zone 2 are dropped.
    assert got == {(1, at(0)): 3, (1, at(100)): 4, (1, at(101)): 5, (1, at(99)): 2}
    cells = spark.read.parquet(run.source)
    for _ in range(2):                                          # a rerun adds nothing
        streams.insert_forgotten(cells, run.out)
        rows = streams.stored_cells(spark, run.out)
        assert rows.count() == 5
    stored = {(r.PULocationID, r.pickup_hour_ts): r.trip_count for r in rows.collect()}
    assert stored == {**got, (2, at(1)): 6}
    # The batch writer, file by file, stores the same keys and, where no cell repeats in one batch, the same counts.
    out = run.out + "-batch"
    write = streams.insert_new_cells(out)
    for i, rows in enumerate(([(1, 0, 3)], [(1, 100, 4)], [(1, 101, 5)], [(1, 0, 77), (2, 1, 6), (1, 99, 2)])):
        write(spark.createDataFrame([(z, at(h), n) for z, h, n in rows], SCHEMA), i)
    assert {(r.PULocationID, r.pickup_hour_ts): r.trip_count for r in spark.read.parquet(out).collect()} == stored


def test_hours_that_clocks_skip_or_repeat_stay_apart(spark, run):
    rows = [(1, h, h + 1) for h in range(0, 24 * 3)]            # 2024-03-10 02:00 does not exist in some zones
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = run(rows, retention="30 days")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {(1, at(h)): n for _, h, n in rows}


def test_state_holds_the_retained_span_only(spark, tmp_path):
    source = str(tmp_path / "in")
    for day in range(6):
        rows = [(z, at(24 * day + h), 1) for z in range(3) for h in range(24)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    cells = streams.parquet_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    query = (streams.first_cells(cells, "1 day").writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6 * 72
    assert max(held) <= 3 * 3 and held[-1] <= 2 * 3            # zones times days
