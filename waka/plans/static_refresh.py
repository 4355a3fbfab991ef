"""Static feed refresh, and C5: single-route exploration.

C1 has three phases:
  1. stop_times + stops only -> candidate trips (relational division, D4);
  2. the shapes join (J4) only for candidate trips and their shapes (semi-joins);
  3. all trips' consecutive stop pairs, kept if they form a key segment.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import network as nw
from ..session import materialize


@dataclass
class FeedTables:
    calendar: DataFrame
    stops: DataFrame
    stop_times: DataFrame
    trips: DataFrame
    shapes: DataFrame


class RefreshResult:
    """The tables of a refresh, each built when it is first asked for. What several of them read (the trips' stop codes, the candidate trips,
    the key segments, the trips over them) is stored once in the shared checkpoint folder, narrow, and not held in memory."""

    def __init__(self, feed: FeedTables, journeys: DataFrame):
        self.feed, self.journeys = feed, journeys

    @cached_property
    def codes(self) -> DataFrame:
        return materialize(nw.trip_stop_codes(self.feed.stop_times, self.feed.stops), "stop_codes")

    @cached_property
    def candidates(self) -> DataFrame:                                         # phase 1
        return materialize(nw.candidate_trips(self.codes, self.journeys), "candidate_trips")

    @cached_property
    def candidate_rows(self) -> tuple[DataFrame, DataFrame]:                   # phase 2
        return (self.feed.trips.join(self.candidates, "trip_id", "left_semi"), self.codes.join(self.candidates, "trip_id", "left_semi"))

    @cached_property
    def key_segments(self) -> DataFrame:
        trips, codes = self.candidate_rows
        shapes = self.feed.shapes.join(trips.select("shape_id"), "shape_id", "left_semi")
        on_shape = nw.on_shape_stops(trips, codes, self.feed.stops, shapes)
        return materialize(nw.key_segments(nw.key_trips(on_shape, self.journeys)), "key_segments")

    @cached_property
    def trip_segments(self) -> DataFrame:                                      # phase 3
        return materialize(nw.trips_over_segments(self.codes, self.key_segments), "trip_segments")

    @property
    def calendar(self) -> DataFrame:
        return self.feed.calendar

    @property
    def stops(self) -> DataFrame:
        trips, codes = self.candidate_rows
        return candidate_stops(trips, codes, self.feed.stops)

    @property
    def trips(self) -> DataFrame:
        return nw.relevant_trips(self.feed.trips, self.trip_segments)

    @property
    def segments(self) -> DataFrame:
        return nw.unique_segments(self.key_segments)


def build_refresh(feed: FeedTables, journeys: DataFrame) -> RefreshResult:
    return RefreshResult(feed, journeys)


def candidate_stops(cand_trips: DataFrame, cand_codes: DataFrame, stops: DataFrame) -> DataFrame:
    """J2 + D1: the distinct stop rows visited by candidate trips (the stops table)."""
    rows = cand_codes.select("trip_id", "stop_id").join(cand_trips.select("trip_id"), "trip_id")
    used = rows.select("stop_id").distinct()
    return stops.select("stop_id", "location_type", "stop_code", "stop_lat", "stop_lon", "stop_name").join(
        used, "stop_id", "left_semi").distinct()


def refresh_counts(r: RefreshResult) -> DataFrame:
    """K6: the four refresh counts as one small DataFrame (each a scalar subquery)."""
    parts = [("stops", r.stops), ("trips", r.trips), ("trip_segments", r.trip_segments), ("segments", r.segments)]
    first = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        first = one if first is None else first.unionByName(one)
    return first


def explore_route(feed: FeedTables, routes: list[str], journeys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trips of the given routes whose on-shape stops hit the journey exactly
    (P2 -> J1 -> J2 -> J4 -> W6 -> D5). Returns (key trips, ordered stop lists)."""
    rtrips = feed.trips.where(F.col("route_id").isin(routes))
    codes = nw.trip_stop_codes(feed.stop_times.join(rtrips.select("trip_id"), "trip_id", "left_semi"), feed.stops)
    shapes = feed.shapes.join(rtrips.select("shape_id"), "shape_id", "left_semi")
    on_shape = nw.on_shape_stops(rtrips, codes, feed.stops, shapes)
    kstops = nw.key_trips(on_shape, journeys)
    lists = nw.ordered_stops(kstops)
    trips_out = kstops.select("route_id", "trip_id", "service_id", "direction_id", "shape_id").distinct()
    return trips_out, lists
