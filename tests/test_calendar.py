from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kerbcast.functions.city_events import event_calendar
from kerbcast.functions.scalars import cut
from kerbcast.functions.timeparts import epoch_hours, hour_floor, last_weekday, nth_weekday
from kerbcast.operators.demand import with_calendar, with_city_event, with_holiday, with_listed_event


def years(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "year int")


def test_date_rules(spark):
    row = years(spark, 2024).select(
        nth_weekday(F.col("year"), 11, 6).alias("a"), nth_weekday(F.col("year"), 11, 3, 4).alias("b"),
        last_weekday(F.col("year"), 6, 6).alias("c"),
    ).first()
    assert tuple(row) == (date(2024, 11, 3), date(2024, 11, 28), date(2024, 6, 30))


@pytest.mark.parametrize("year, expected", [(2020, (1, 26, 28)), (2026, (1, 26, 28)), (2027, (7, 25, 27))])
def test_date_rules_when_the_month_starts_on_the_day(spark, year, expected):
    row = years(spark, year).select(
        nth_weekday(F.col("year"), 11, 6), nth_weekday(F.col("year"), 11, 3, 4), last_weekday(F.col("year"), 6, 6)
    ).first()
    assert tuple(d.day for d in row) == expected


def test_calendar_pairs(spark):
    pairs = {tuple(r) for r in event_calendar(years(spark, 2024)).collect()}
    assert len({d for d, _ in pairs}) == 7
    assert (date(2024, 12, 31), 161) in pairs and (date(2024, 12, 31), 230) in pairs
    assert (date(2024, 6, 15), 161) not in pairs
    assert event_calendar(years(spark, 2023, 2024, 2024)).count() > len(pairs)


def test_event_flag_both_ways(spark):
    rows = [(datetime(2024, 12, 31, 20), 161), (datetime(2024, 6, 15, 12), 161), (datetime(2024, 12, 31, 20), 1)]
    df = spark.createDataFrame(rows, "pickup_hour_ts timestamp_ntz, PULocationID int")
    by_rule = [r["is_nyc_event"] for r in with_city_event(df).orderBy("pickup_hour_ts", F.desc("PULocationID")).collect()]
    listed = with_listed_event(df, event_calendar(years(spark, 2024)))
    by_table = [r["is_nyc_event"] for r in listed.orderBy("pickup_hour_ts", F.desc("PULocationID")).collect()]
    assert by_rule == by_table == [0, 1, 0]


def test_calendar_parts(spark):
    rows = [(datetime(2024, 1, 3, 11), 161), (datetime(2024, 12, 30, 23), 132), (datetime(2024, 6, 1), 1)]
    df = with_calendar(spark.createDataFrame(rows, "pickup_hour_ts timestamp_ntz, PULocationID int"))
    got = [(r["pickup_hour"], r["pickup_dow"], r["pickup_week"], r["pickup_is_weekend"], r["is_airport"])
           for r in df.collect()]
    assert got == [(11, 2, 1, False, 0), (23, 0, 1, False, 1), (0, 5, 22, True, 1)]


def test_holiday_dates_listed_twice_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(datetime(2024, 11, 28, 5),)], "pickup_hour_ts timestamp_ntz")
    days = spark.createDataFrame([(date(2024, 11, 28), "a"), (date(2024, 11, 28), "b")], "date date, name string")
    assert [r["is_holiday"] for r in with_holiday(df, days).collect()] == [1]


def test_hour_floor_in_another_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 15, 5),)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(hour_floor(F.col("t")), epoch_hours(F.col("t"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    hours = (datetime(2024, 3, 10, 2) - datetime(1970, 1, 1)).total_seconds() / 3600
    assert tuple(row) == (datetime(2024, 3, 10, 2), hours)


def test_cut(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 5.0, 5.1, 99.0)], "x double")
    plain = [r[0] for r in df.select(cut(F.col("x"), [0, 5, 15], ["a", "b"])).collect()]
    lowest = [r[0] for r in df.select(cut(F.col("x"), [0, 5, 15], ["a", "b"], lowest=True)).collect()]
    assert plain == [None, "a", "a", "b", None] and lowest[0] == "a"
