"""Raw trips, weather and holidays to the validated demand table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbcast.operators.demand import (
    hourly_demand, with_calendar, with_city_event, with_holiday, with_weather,
)
from kerbcast.operators.validation import (
    DEMAND_COLUMNS, DEMAND_RULES, TRIP_RULES, check, check_unique, require_columns,
)
from kerbcast.schemas import HOUR_TS, ZONE
from kerbcast.session import written


def enrich(cells: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Calendar, weather, holiday and city-event columns on zone-hour cells."""
    return with_city_event(with_holiday(with_weather(with_calendar(cells), weather), holidays))


def build_demand(
    trips: DataFrame, weather: DataFrame, holidays: DataFrame, validate: bool = False
) -> DataFrame:
    """One row per zone and hour with a trip.

    The only shuffle of trip-sized data is the count per zone and hour, which is combined before it.
    A repeated hour of weather would repeat demand rows and raises. With ``validate``, both ends are checked
    and a broken rule or a repeated cell raises. The checked demand is a written table, so that the check and
    the caller do not each count the trips again.
    """
    check_unique(weather, [HOUR_TS], "weather")
    if validate:
        check(trips, TRIP_RULES, "trips")
    demand = enrich(hourly_demand(trips), weather, holidays)
    require_columns(demand, DEMAND_COLUMNS)
    if not validate:
        return demand
    checked = check(written(demand, "checked-demand"), DEMAND_RULES, "demand")
    return check_unique(checked, [ZONE, HOUR_TS], "demand")
