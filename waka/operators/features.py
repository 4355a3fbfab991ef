"""Weekly training-set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_parts, in_week
from ..session import materialize
from .ordered import trip_day_neighbours

AVG_FEATURES = ["bearing", "speed", "delay", "occupancy_status"]
TRIP_DAY = ["trip_id", "day_of_month", "obs_month", "obs_year"]
ORDER = ["timestamp", "id"]

GENERIC_COLUMNS = [
    "id", "timestamp", "trip_id", "segment_id", "day_of_month", "obs_month", "obs_year",
    "direction_id", "bearing", "speed", "delay", "occupancy_status", "stop_id", "end_stop_id",
    "departure_delay", "departure_uncertainty", "obs_minute", "obs_hour", "day_of_week",
]

# Grain of each segment average family: (prefix, extra key beyond segment_id).
AVG_GRAINS = [("global", None), ("daily", "day_of_week"), ("monthly", "obs_month"), ("hourly", "obs_hour")]


def segment_bridge(trip_segments: DataFrame, segments: DataFrame) -> DataFrame:
    """trip_segments widened with the segment's stops."""
    return trip_segments.join(segments, "segment_id")


def match_segments(locations: DataFrame, trip_segments: DataFrame, segments: DataFrame) -> DataFrame:
    """A location matches the segment of its trip that starts at its stop.

    The bridge (trips x their segments) is small next to the locations; the planner
    broadcasts it when its measured size allows, otherwise both sides shuffle on
    (trip_id, stop_id) and AQE splits a hot key.
    """
    bridge = segment_bridge(trip_segments, segments).select(
        "trip_id", F.col("start_stop_id").alias("stop_id"), "segment_id", "end_stop_id"
    )
    return locations.join(bridge, ["trip_id", "stop_id"])


def matched_locations(locations: DataFrame, trip_segments: DataFrame, segments: DataFrame,
                      week_start=None, tz: str = "UTC") -> DataFrame:
    """P6 + J7 + X8: the week's locations (all without a week) matched to segments, with date parts."""
    wk = locations if week_start is None else locations.where(in_week("timestamp", week_start, tz))
    m = match_segments(wk, trip_segments, segments)
    return m.select(
        "id", "timestamp", "segment_id", "trip_id", "stop_id", "end_stop_id", "stop_sequence",
        "direction_id", "bearing", "speed", "delay", "departure_delay", "departure_uncertainty",
        "occupancy_status", "latitude", "longitude",
        *[c.alias(n) for n, c in date_parts("timestamp", tz).items()],
    )


def generic_features(matched: DataFrame) -> DataFrame:
    """The 19 pass-through columns."""
    return matched.select(*GENERIC_COLUMNS)


def segment_sums(matched: DataFrame, cols=AVG_FEATURES, by=()) -> DataFrame:
    """One partial aggregate at (segment, day_of_week, obs_month, obs_hour), and the keys ``by``: sum and
    non-null count per feature. Every coarser grain is derived from this small frame,
    so the big input is shuffled once (map-side combined) instead of four times."""
    aggs = []
    for c in cols:
        aggs += [F.sum(F.col(c).cast("double")).alias(f"s_{c}"), F.count(c).alias(f"n_{c}")]
    return matched.groupBy(*by, "segment_id", "day_of_week", "obs_month", "obs_hour").agg(*aggs)


def _roll(sums: DataFrame, prefix: str, key: str | None, cols, by=()) -> DataFrame:
    keys = [*by, "segment_id"] + ([key] if key else [])
    aggs = [
        (F.sum(f"s_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0))).alias(f"{prefix}_{c}_avg")
        for c in cols
    ]
    return sums.groupBy(*keys).agg(*aggs)


def segment_averages(matched: DataFrame, cols=AVG_FEATURES) -> dict[str, DataFrame]:
    """A2-A5: mean of each feature per segment, per (segment, weekday), per
    (segment, month) and per (segment, hour); nulls skipped, all-null -> null."""
    sums = segment_sums(matched, cols)
    return {p: _roll(sums, p, k, cols) for p, k in AVG_GRAINS}


def segment_average_table(matched: DataFrame, cols=AVG_FEATURES, by=()) -> DataFrame:
    """All 16 averages keyed by the fine grain (segment, dow, month, hour), within each group of ``by``.

    Built from the small partial aggregate, so the training set needs a single join
    on the fine key instead of four joins against the large side. The aggregate is stored: the
    grains and the fine keys read it, not the locations five times.
    """
    sums = materialize(segment_sums(matched, cols, by), "segment_sums")
    fine = sums.select(*by, "segment_id", "day_of_week", "obs_month", "obs_hour")
    for p, k in AVG_GRAINS:
        keys = [*by, "segment_id"] + ([k] if k else [])
        fine = fine.join(_roll(sums, p, k, cols, by), keys, "left")
    return fine


def lag_features(matched: DataFrame, cols=AVG_FEATURES) -> DataFrame:
    """Previous value, and means of the current + 4 / + 9 previous values,
    per trip-day in (timestamp, id) order, nulls skipped."""
    out = trip_day_neighbours(matched, TRIP_DAY, ORDER, cols, lags=(1,), means=(5, 10), leads=())
    keep = ["id", "timestamp"] + [c for c in out.columns if "_lag_" in c]
    return out.select(*keep)


def next_position(matched: DataFrame) -> DataFrame:
    """The next observation's latitude / longitude within the trip-day."""
    out = trip_day_neighbours(matched, TRIP_DAY, ORDER, ["latitude", "longitude"], lags=(), means=(), leads=(1,))
    return out.select("id", "timestamp",
                      F.col("1_lead_longitude").alias("target_longitude"),
                      F.col("1_lead_latitude").alias("target_latitude"))


def lag_column_names(cols=AVG_FEATURES) -> list[str]:
    return [f"1_lag_{c}" for c in cols] + [f"5_lag_{c}_avg" for c in cols] + [f"10_lag_{c}_avg" for c in cols]


def avg_column_names(cols=AVG_FEATURES) -> list[str]:
    return [f"{p}_{c}_avg" for p, _ in AVG_GRAINS for c in cols]


def training_set(matched: DataFrame, cols=AVG_FEATURES, by=(), present=None) -> DataFrame:
    """J8 + P5 (with averages within each group of ``by``): generic features, the 16 segment averages, lags and the next-position
    target; rows without a next position are dropped.

    Lags and target come from one neighbour pass over the same rows, so the
    reference's two (id, timestamp) self-joins are not needed: each matched location
    is one row (checked by Q1 before writing). The averages are stored, ``present`` (a function of their table) applied:
    the planner then knows their size and, where they are few, doesn't shuffle the locations for them.
    """
    avgs = segment_average_table(matched, cols, by)
    avgs = materialize(present(avgs) if present else avgs, "segment_averages")
    nb = trip_day_neighbours(matched, TRIP_DAY, ORDER, cols + ["latitude", "longitude"],
                             lags=(1,), means=(5, 10), leads=(1,), mean_cols=cols, lag_cols=cols,
                             lead_cols=["latitude", "longitude"])
    nb = nb.withColumnsRenamed({"1_lead_longitude": "target_longitude", "1_lead_latitude": "target_latitude"})
    joined = nb.join(avgs, [*by, "segment_id", "day_of_week", "obs_month", "obs_hour"], "left")
    return (
        joined.where(F.col("target_latitude").isNotNull() & F.col("target_longitude").isNotNull())
        .select(*GENERIC_COLUMNS, *avg_column_names(cols), *lag_column_names(cols),
                "target_longitude", "target_latitude")
    )
