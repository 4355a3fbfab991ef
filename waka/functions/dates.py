"""Date and time column functions (X8, X9, X11, P6 bounds)."""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday labels indexed by day_of_week (0 = Sunday), and the
# calendar's weekday column names in Monday-first order.
DOW_LABELS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
WEEKDAY_NAMES = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

FEED_TZ = "Pacific/Auckland"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(epoch, tz: str = "UTC") -> Column:
    """Epoch seconds -> timestamp whose fields read as wall-clock time in ``tz``.

    The session zone is pinned to UTC, so ``from_utc_timestamp`` yields the local
    wall clock and ``hour()``/``dayofweek()`` read it directly.
    """
    ts = F.timestamp_seconds(_c(epoch))
    return ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)


def date_parts(epoch, tz: str = "UTC") -> dict[str, Column]:
    """Minute, hour, day of week (0 = Sunday), day, month, year, weekday flag."""
    t = local_time(epoch, tz)
    dow = (F.dayofweek(t) - 1).cast("int")
    return {
        "obs_minute": F.minute(t).cast("int"),
        "obs_hour": F.hour(t).cast("int"),
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(t).cast("int"),
        "obs_month": F.month(t).cast("int"),
        "obs_year": F.year(t).cast("int"),
        "is_weekday": dow.between(1, 5),
    }


def with_date_parts(df, epoch_col: str = "timestamp", tz: str = "UTC"):
    return df.withColumns(date_parts(epoch_col, tz))


def week_end(week_start) -> Column:
    """X11: the (exclusive) end of a week starting at ``week_start``."""
    return F.date_add(_c(week_start), 7)


def week_bounds(week_start: _dt.date | str, tz: str = "UTC") -> tuple[int, int]:
    """Epoch bounds of local dates [week_start, week_start + 7d) in ``tz``.

    Comparing the stored epoch column to two constants (rather than casting every
    row to a date) keeps the predicate pushable into the parquet scan.
    """
    if isinstance(week_start, str):
        week_start = _dt.date.fromisoformat(week_start)
    zone = ZoneInfo(tz)
    lo = _dt.datetime.combine(week_start, _dt.time(0), zone)
    hi = _dt.datetime.combine(week_start + _dt.timedelta(days=7), _dt.time(0), zone)
    return int(lo.timestamp()), int(hi.timestamp())


def in_week(epoch, week_start, tz: str = "UTC") -> Column:
    lo, hi = week_bounds(week_start, tz)
    e = _c(epoch)
    return (e >= F.lit(lo)) & (e < F.lit(hi))


def local_start(date_col, time_col, tz: str = FEED_TZ) -> Column:
    """(start_date 'yyyyMMdd', start_time 'H:m:s') wall time in ``tz`` -> instant.

    Unparsable input (hour >= 24, missing part) gives null, so the row is rejected by
    validation. In the repeated hour at the end of daylight time the later (standard
    time) instant is chosen; in the skipped hour the clock is moved forward.
    """
    d, t = _c(date_col), _c(time_col)
    ok = d.isNotNull() & t.isNotNull() & (F.length(d) > 0) & (F.length(t) > 0)
    wall = F.try_to_timestamp(F.concat_ws(" ", d, t), F.lit("yyyyMMdd H:m:s"))
    u = F.to_utc_timestamp(wall, tz)
    later = u + F.expr("INTERVAL 1 HOUR")
    pick = F.when(F.from_utc_timestamp(later, tz) == wall, later).otherwise(u)
    return F.when(ok, pick)


def weekday_name(date_col) -> Column:
    """Lower-case English weekday name of a date ('monday' .. 'sunday')."""
    return F.lower(F.date_format(_c(date_col), "EEEE"))
