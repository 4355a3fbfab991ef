"""Static network operators (C1, C5): journeys, candidate trips, on-shape stops,
ordered stop lists, key segments and the trips that traverse them.

Nothing is collected to the driver: the reference's id lists become semi-joins, its
per-trip Python loop becomes relational division, and its list programs become
windows over (trip, stop_sequence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.strings import segment_id
from ..session import materialize
from .ordered import trip_day_neighbours

STOP_FIELDS = ["stop_id", "stop_code", "stop_lat", "stop_lon", "stop_sequence"]
TRIP_COLUMNS = ["trip_id", "route_id", "service_id", "direction_id", "shape_id"]


def journeys_df(spark: SparkSession, journeys) -> DataFrame:
    """Journeys (lists of stop codes) as rows (journey_id, pos, stop_code). Joins with them
    are left to the size-checked choice of the optimizer: there may be thousands."""
    rows = [(j, p, str(c)) for j, codes in enumerate(journeys) for p, c in enumerate(codes)]
    return spark.createDataFrame(rows, "journey_id int, pos int, stop_code string")


def journey_sizes(journeys: DataFrame) -> DataFrame:
    """Set size (distinct codes, for D4) and list length (for D5) per journey."""
    return journeys.groupBy("journey_id").agg(
        F.count_distinct("stop_code").alias("set_size"), F.count(F.lit(1)).alias("list_size"))


def trip_stop_codes(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """stop_times with each stop's code (inner join on stop_id)."""
    return stop_times.select("trip_id", "stop_id", "stop_sequence").join(
        stops.select("stop_id", "stop_code"), "stop_id")


def trips_with_all(held: DataFrame, journeys: DataFrame) -> DataFrame:
    """(trip_id, journey_id) where the trip has every code of the journey. ``held``: distinct (trip_id, stop_code).

    An inverted list on each journey's rarest code: only trips with that code are looked at, and of these the
    journey's other codes are looked up, one by one, and counted. A journey with a code that no
    trip has ends at once. What is joined grows with the hits of the rarest codes, not with those of every code of every journey.
    """
    held = materialize(held.where(F.col("stop_code").isNotNull()), "trip_codes")      # read by the counts, the lists and the look-ups
    wanted = journeys.select("journey_id", "stop_code").where(F.col("stop_code").isNotNull()).distinct()
    often = (held.join(wanted.select("stop_code").distinct(), "stop_code", "left_semi")
             .groupBy("stop_code").agg(F.count(F.lit(1)).alias("n_trips")))
    rarest = (wanted.join(often, "stop_code", "left").groupBy("journey_id")
              .agg(F.min(F.struct(F.coalesce("n_trips", F.lit(0)).alias("n_trips"), "stop_code")).alias("r"),
                   F.count(F.lit(1)).alias("set_size"))
              .where(F.col("r.n_trips") > 0).select("journey_id", F.col("r.stop_code").alias("stop_code"), "set_size"))
    rarest = materialize(rarest, "rarest_codes")
    rest = wanted.join(rarest.select("journey_id", "stop_code"), ["journey_id", "stop_code"], "left_anti")
    listed = held.join(rarest, "stop_code").select("trip_id", "journey_id", "set_size")
    single = listed.where(F.col("set_size") == 1).select("trip_id", "journey_id")
    asked = listed.where(F.col("set_size") > 1).join(rest, "journey_id")
    met = (asked.join(held, ["trip_id", "stop_code"], "left_semi").groupBy("trip_id", "journey_id", "set_size")
           .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.col("set_size") - 1))
    return single.unionByName(met.select("trip_id", "journey_id"))


def candidate_trips(trip_codes: DataFrame, journeys: DataFrame) -> DataFrame:
    """Trips whose set of stop codes contains every code of at least one journey (relational division)."""
    return trips_with_all(trip_codes.select("trip_id", "stop_code").distinct(), journeys).select("trip_id").distinct()


def on_shape_stops(trips: DataFrame, trip_codes: DataFrame, stops: DataFrame, shapes: DataFrame) -> DataFrame:
    """J2 + J3 + J4 + D1: a trip's stops that lie exactly on the trip's shape.

    The shape is reduced to distinct (shape_id, lat, lon) points first and used as a
    semi-join filter, which gives the reference's inner-join-then-unique result
    without the fan-out on repeated shape points.
    """
    rows = (trip_codes.select("trip_id", "stop_id", "stop_sequence")
            .join(trips.select(*TRIP_COLUMNS), "trip_id")
            .join(stops.select("stop_id", "stop_code", "stop_lat", "stop_lon"), "stop_id"))
    pts = shapes.select("shape_id", F.col("shape_pt_lat").alias("stop_lat"),
                        F.col("shape_pt_lon").alias("stop_lon")).distinct()
    on = rows.join(pts, ["shape_id", "stop_lat", "stop_lon"], "left_semi")
    return on.select("route_id", "trip_id", "service_id", "direction_id", "shape_id",
                     "stop_id", "stop_code", "stop_lat", "stop_lon", "stop_sequence").distinct()


def ordered_stops(trip_stops: DataFrame) -> DataFrame:
    """W6 + X1: per trip, the list of stop structs ordered by stop_sequence.

    A trip's list is bounded by its schedule (one entry per scheduled stop), so
    gathering it per trip is bounded; ``array_sort`` on a struct led by the sequence
    orders it without a global sort.
    """
    keyed = F.struct(F.col("stop_sequence").alias("k"), F.struct(*STOP_FIELDS).alias("s"))
    trip_cols = [c for c in ["route_id", "service_id", "direction_id", "shape_id"] if c in trip_stops.columns]
    agg = trip_stops.groupBy("trip_id", *trip_cols).agg(F.array_sort(F.collect_list(keyed)).alias("_l"))
    return agg.select("trip_id", *trip_cols, F.transform("_l", lambda e: e["s"]).alias("stops"))


def occurrence_match(trip_stops: DataFrame, journeys: DataFrame) -> DataFrame:
    """(trip, journey) pairs where the number of the trip's on-shape stops whose
    code is in the journey equals the journey's list length (a repeated stop counts
    twice).

    A trip that stops nowhere twice reaches the length only with every code of a
    journey whose list has no code twice: these pairs come from the inverted list (``trips_with_all``). Only
    the trips with a repeated code are counted against every journey they meet.
    """
    per = materialize(trip_stops.groupBy("trip_id", "stop_code").agg(F.count(F.lit(1)).alias("n")), "trip_code_counts")
    twice = per.where(F.col("n") > 1).select("trip_id").distinct()
    sizes = journey_sizes(journeys)
    plain = sizes.where(F.col("set_size") == F.col("list_size")).select("journey_id")
    listed = trips_with_all(per.join(twice, "trip_id", "left_anti").select("trip_id", "stop_code"),
                            journeys.join(plain, "journey_id", "left_semi"))
    hits = per.join(twice, "trip_id", "left_semi").join(journeys.select("journey_id", "stop_code").distinct(), "stop_code")
    counted = hits.groupBy("trip_id", "journey_id").agg(F.sum("n").alias("n")).join(sizes, "journey_id").where(
        F.col("n") == F.col("list_size")).select("trip_id", "journey_id")
    return listed.unionByName(counted)


def key_trips(trip_stops: DataFrame, journeys: DataFrame) -> DataFrame:
    """Trips (on-shape stop rows) passing D5 for any journey."""
    ok = occurrence_match(trip_stops, journeys).select("trip_id").distinct()
    return trip_stops.join(ok, "trip_id", "left_semi")


def next_in_trip(rows: DataFrame, cols, names: dict) -> DataFrame:
    """W1 + X3: each stop row with the next stop's values within its trip (ordered by
    stop_sequence). Uses the hot-group safe neighbour pass, so a very long trip is cut
    into slices instead of being sorted in one task."""
    out = trip_day_neighbours(rows, ["trip_id"], ["stop_sequence"], list(cols), lags=(), means=(), leads=(1,))
    return out.withColumnsRenamed({f"1_lead_{c}": names[c] for c in cols})


def consecutive_pairs(rows: DataFrame, code: str = "stop_code", extra=("stop_id", "stop_lat", "stop_lon")) -> DataFrame:
    """Each stop row with the next row's values; the last stop of a trip has no
    successor and is dropped."""
    names = {"stop_code": "end_stop", "stop_id": "end_stop_id", "stop_lat": "end_lat", "stop_lon": "end_lon"}
    cols = (code, *extra)
    out = next_in_trip(rows, cols, {c: names.get(c, f"end_{c}") for c in cols})
    return out.where(F.col("end_stop").isNotNull())


def key_segments(key_trip_stops: DataFrame) -> DataFrame:
    """Segments between consecutive on-shape stops of the key trips."""
    pairs = consecutive_pairs(key_trip_stops)
    return pairs.select(
        "trip_id", "route_id", "service_id", "direction_id", "shape_id",
        F.col("stop_code").alias("start_stop"), "end_stop",
        F.col("stop_id").alias("start_stop_id"), "end_stop_id",
        F.col("stop_lat").alias("start_lat"), "end_lat",
        F.col("stop_lon").alias("start_lon"), "end_lon",
        segment_id("stop_code", "end_stop").alias("segment_id"),
    )


def unique_segments(key_segs: DataFrame) -> DataFrame:
    """One (segment_id, start_stop_id, end_stop_id) per segment id, chosen
    deterministically (smallest stop pair)."""
    return key_segs.groupBy("segment_id").agg(
        F.min(F.struct("start_stop_id", "end_stop_id")).alias("m")).select(
        "segment_id", "m.start_stop_id", "m.end_stop_id")


def trips_over_segments(trip_codes: DataFrame, segment_ids: DataFrame) -> DataFrame:
    """Phase 3: (trip_id, segment_id) for every trip whose consecutive stops form one of
    the given segments, over all stop_times (W1 -> X6 -> J5 -> D1)."""
    nxt = next_in_trip(trip_codes.select("trip_id", "stop_sequence", "stop_code"), ["stop_code"],
                       {"stop_code": "end_stop_code"})
    segs = nxt.where(F.col("end_stop_code").isNotNull()).select(
        "trip_id", segment_id("stop_code", "end_stop_code").alias("segment_id"))
    return segs.join(segment_ids.select("segment_id").distinct(), "segment_id", "left_semi").select(
        "trip_id", "segment_id").distinct()


def relevant_trips(trips: DataFrame, trip_segs: DataFrame) -> DataFrame:
    """Trips present in trip_segments (semi-join, no id list on the driver)."""
    return trips.select(*TRIP_COLUMNS).distinct().join(trip_segs.select("trip_id"), "trip_id", "left_semi")


def unmatched_by_stop(locations: DataFrame, trip_segments: DataFrame, segments: DataFrame) -> DataFrame:
    """Locations with no segment of their trip starting at their stop, counted per stop."""
    bridge = trip_segments.join(segments, "segment_id").select(
        "trip_id", F.col("start_stop_id").alias("stop_id"))
    return locations.join(bridge, ["trip_id", "stop_id"], "left_anti").groupBy("stop_id").agg(
        F.count(F.lit(1)).alias("n"))


def member_count(codes: Column, journey: list) -> Column:
    """Number of elements of an array of codes that are in ``journey``."""
    vals = [str(x) for x in journey]
    return F.size(F.filter(codes, lambda x: x.isin(vals)))
