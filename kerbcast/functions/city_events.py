"""Yearly city events: the dates follow calendar rules, the places are fixed lists of zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.timeparts import last_weekday, nth_weekday

# Zones near the event sites.
TIMES_SQUARE = [161, 162, 163, 164, 230, 186]
CENTRAL_PARK = [140, 141, 142, 161, 239]
FIFTH_AVENUE = [161, 162, 163, 230, 236, 237]
WEST_VILLAGE = [68, 79, 113, 249]
HUDSON = [140, 141, 142, 236, 237]
# End of fixed values.


def _day(month: int, day: int):
    return lambda year: F.make_date(year, F.lit(month), F.lit(day))


# Event name, date rule, event sites.
EVENTS = [
    ("new_years_eve", _day(12, 31), [TIMES_SQUARE]),
    ("independence_day", _day(7, 4), [HUDSON, TIMES_SQUARE]),
    ("st_patricks_day", _day(3, 17), [FIFTH_AVENUE]),
    ("halloween", _day(10, 31), [WEST_VILLAGE]),
    ("marathon", lambda year: nth_weekday(year, 11, 6), [CENTRAL_PARK, FIFTH_AVENUE]),
    ("thanksgiving", lambda year: nth_weekday(year, 11, 3, 4), [CENTRAL_PARK, TIMES_SQUARE]),
    ("pride_march", lambda year: last_weekday(year, 6, 6), [FIFTH_AVENUE, WEST_VILLAGE]),
]
# End of fixed values.


def _zones(sites: list[list[int]]) -> list[int]:
    return sorted({zone for site in sites for zone in site})


def event_calendar(years: DataFrame, year: str = "year") -> DataFrame:
    """Distinct (event_date, zone_id) pairs of all events in the given years."""
    rows = F.array(*[
        F.struct(
            rule(F.col(year)).alias("event_date"),
            F.array(*[F.lit(z) for z in _zones(sites)]).alias("zones"),
        )
        for _, rule, sites in EVENTS
    ])
    return (
        years.select(F.col(year).cast("int").alias(year)).distinct()
        .select(F.inline(rows))
        .select("event_date", F.explode("zones").alias("zone_id"))
        .distinct()
    )


def at_city_event(ts: Column, zone: Column) -> Column:
    """1 when an event takes place near the zone on that day, else 0.

    The rules are evaluated in the row itself: no lookup table, no join, no shuffle.
    """
    day, year = F.to_date(ts), F.year(ts)
    hit = F.lit(False)
    for _, rule, sites in EVENTS:
        hit = hit | (zone.isin(_zones(sites)) & (day == rule(year)))
    return F.coalesce(hit, F.lit(False)).cast("int")
