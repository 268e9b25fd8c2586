"""Time arithmetic on naive timestamps that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def interval_micros(span: Column) -> Column:
    """Length of a day-time interval in microseconds."""
    part = lambda field: F.extract(F.lit(field), span).cast("long")
    seconds = F.extract(F.lit("SECOND"), span) * 1_000_000
    return (
        part("DAY") * 86_400_000_000 + part("HOUR") * 3_600_000_000
        + part("MINUTE") * 60_000_000 + seconds.cast("long")
    )


def epoch_micros(ts: Column) -> Column:
    return interval_micros(ts - F.lit("1970-01-01").cast("timestamp_ntz"))


def epoch_hours(ts: Column) -> Column:
    return F.floor(epoch_micros(ts) / 3_600_000_000).cast("long")


def minutes_between(start: Column, stop: Column) -> Column:
    """Elapsed minutes, fractions of a second included."""
    return interval_micros(stop - start) / 60_000_000.0


def hour_floor(ts: Column) -> Column:
    """Start of the hour; stays TIMESTAMP_NTZ, unlike ``date_trunc``."""
    into_hour = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts)
    )
    return ts - into_hour


def plus_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def month_start(year: int, month: int) -> Column:
    return F.lit(f"{year:04d}-{month:02d}-01").cast("timestamp_ntz")


def nth_weekday(year: Column, month: int, weekday: int, n: int = 1) -> Column:
    """Date of the n-th given weekday (Monday is 0) of a month."""
    eve = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(eve, _WEEKDAYS[weekday]), 7 * (n - 1))


def last_weekday(year: Column, month: int, weekday: int) -> Column:
    month_end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(F.next_day(month_end, _WEEKDAYS[weekday]), 7)
