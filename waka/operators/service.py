"""Service days (X10) and active trips.

The reference asks "which services run today" for one date through a holiday
library. Here the question is vectorised over any number of dates: a dates frame is
matched to the unpivoted calendar; public holidays come in as a small table and
turn the day into a Sunday.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import WEEKDAY_NAMES, weekday_name


def calendar_long(calendar: DataFrame) -> DataFrame:
    """Unpivot the seven weekday flags: (service_id, day_name, runs)."""
    stack = ", ".join(f"'{d}', cast({d} as int)" for d in WEEKDAY_NAMES)
    return calendar.selectExpr("service_id", f"stack(7, {stack}) as (day_name, runs)")


def service_days(calendar: DataFrame, dates: DataFrame, holidays: DataFrame | None = None,
                 date_col: str = "service_date") -> DataFrame:
    """(service_date, day_name, service_id) for every service running on each date.

    ``holidays`` has one column ``holiday`` (date); a holiday runs the Sunday
    timetable. The dates side carries few distinct values (one per day), the calendar
    a few thousand rows, so the equi-join on day name is small on both sides.
    """
    d = dates.select(F.col(date_col).cast("date").alias("service_date")).distinct()
    if holidays is not None:
        h = holidays.select(F.col("holiday").cast("date").alias("service_date"), F.lit(True).alias("_hol")).distinct()
        d = d.join(h, "service_date", "left")
        day = F.when(F.col("_hol"), F.lit("sunday")).otherwise(weekday_name("service_date"))
    else:
        day = weekday_name("service_date")
    d = d.select("service_date", day.alias("day_name"))
    runs = calendar_long(calendar).where(F.col("runs") == 1).select("service_id", "day_name")
    return d.join(runs, "day_name").select("service_date", "day_name", "service_id")


def active_trips(trips: DataFrame, services: DataFrame) -> DataFrame:
    """Trips whose service runs on the date(s) in ``services`` (semi-join)."""
    return trips.join(services.select("service_id").distinct(), "service_id", "left_semi")
