"""Registered queries: static network refresh (C1), exploration (C5) and their operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import network as nw
from ..operators import quality as qa
from ..oracle import with_views
from ..sources import transit_views as tv
from . import static_refresh as sr
from .registry import register

# Fixture journey (list of stop codes) and exploration routes.
JOURNEYS = [["3", "7"]]
ROUTES = ["R3", "R7"]


def feed(spark, sf) -> sr.FeedTables:
    return sr.FeedTables(tv.calendar(spark, sf), tv.stops(spark, sf), tv.stop_times(spark, sf),
                         tv.trips(spark, sf), tv.shapes(spark, sf))


def journeys(spark):
    return nw.journeys_df(spark, JOURNEYS)


def refresh(spark, sf) -> sr.RefreshResult:
    return sr.build_refresh(feed(spark, sf), journeys(spark))


_J = "select * from (values " + ", ".join(
    f"({j}, {p}, '{c}')" for j, codes in enumerate(JOURNEYS) for p, c in enumerate(codes)) + ") v(journey_id, pos, stop_code)"

NET = {
    "journeys": _J,
    "jsz": "select journey_id, count(distinct stop_code) set_size, count(*) list_size from journeys group by journey_id",
    "tsc": "select st.trip_id, st.stop_id, st.stop_sequence, s.stop_code from stop_times st join stops s using (stop_id)",
    "cand": """select distinct trip_id from (
        select t.trip_id, j.journey_id, count(distinct t.stop_code) n
        from tsc t join (select distinct journey_id, stop_code from journeys) j using (stop_code) group by 1, 2) q
        join jsz using (journey_id) where n = set_size""",
    "ctrips": "select * from trips where trip_id in (select trip_id from cand)",
    "onshape": """select distinct t.route_id, t.trip_id, t.service_id, t.direction_id, t.shape_id, x.stop_id,
        s.stop_code, s.stop_lat, s.stop_lon, x.stop_sequence
        from ctrips t join tsc x using (trip_id) join stops s on s.stop_id = x.stop_id
        join shapes sh on sh.shape_id = t.shape_id and sh.shape_pt_lat = s.stop_lat and sh.shape_pt_lon = s.stop_lon""",
    "occ": """select o.trip_id, j.journey_id from onshape o
        join (select distinct journey_id, stop_code from journeys) j using (stop_code)
        group by 1, 2 having count(*) = (select list_size from jsz where jsz.journey_id = j.journey_id)""",
    "kstops": "select * from onshape where trip_id in (select trip_id from occ)",
    "kseg": """select trip_id, route_id, service_id, direction_id, shape_id, stop_code start_stop, end_stop,
        stop_id start_stop_id, end_stop_id, stop_lat start_lat, end_lat, stop_lon start_lon, end_lon,
        stop_code || '-' || end_stop segment_id from (
          select *, lead(stop_code) over w end_stop, lead(stop_id) over w end_stop_id,
                 lead(stop_lat) over w end_lat, lead(stop_lon) over w end_lon
          from kstops window w as (partition by trip_id order by stop_sequence)) q where end_stop is not null""",
    "tseg": """select distinct trip_id, segment_id from (
        select trip_id, stop_code || '-' || lead(stop_code) over (partition by trip_id order by stop_sequence) segment_id
        from tsc) q where segment_id is not null and segment_id in (select segment_id from kseg)""",
    "useg": """select segment_id, min({'a': start_stop_id, 'b': end_stop_id}).a start_stop_id,
        min({'a': start_stop_id, 'b': end_stop_id}).b end_stop_id from kseg group by segment_id""",
    "rtrips": """select distinct trip_id, route_id, service_id, direction_id, shape_id from trips
        where trip_id in (select trip_id from tseg)""",
    "cstops": """select distinct stop_id, location_type, stop_code, stop_lat, stop_lon, stop_name from stops
        where stop_id in (select stop_id from tsc where trip_id in (select trip_id from cand))""",
}
ORDER = list(NET)


def net_sql(upto: str, body: str) -> str:
    names = ORDER[: ORDER.index(upto) + 1]
    return with_views("stops", "stop_times", "trips", "shapes", "calendar", extra={k: NET[k] for k in names}) + body


@register("J1_stop_codes", net_sql("tsc", "select * from tsc"))
def j1(spark, sf):
    return nw.trip_stop_codes(tv.stop_times(spark, sf), tv.stops(spark, sf))


@register("D4_candidate_trips", net_sql("cand", "select * from cand"))
def d4(spark, sf):
    return nw.candidate_trips(nw.trip_stop_codes(tv.stop_times(spark, sf), tv.stops(spark, sf)), journeys(spark))


@register("J5_semi_join_candidates", net_sql("ctrips", "select * from ctrips"))
def j5(spark, sf):
    cand = d4(spark, sf)
    return tv.trips(spark, sf).join(cand, "trip_id", "left_semi")


@register("J2_candidate_stop_rows", net_sql("ctrips", """
select x.trip_id, x.stop_id, x.stop_sequence, t.route_id, t.service_id, t.direction_id, t.shape_id,
       s.location_type, s.stop_code, s.stop_lat, s.stop_lon, s.stop_name
from tsc x join ctrips t using (trip_id) join stops s on s.stop_id = x.stop_id"""))
def j2(spark, sf):
    codes = nw.trip_stop_codes(tv.stop_times(spark, sf), tv.stops(spark, sf))
    cand = nw.candidate_trips(codes, journeys(spark))
    ct = tv.trips(spark, sf).join(cand, "trip_id", "left_semi")
    rows = codes.drop("stop_code").join(cand, "trip_id", "left_semi").join(ct, "trip_id")
    return rows.join(tv.stops(spark, sf), "stop_id").select(
        "trip_id", "stop_id", "stop_sequence", "route_id", "service_id", "direction_id", "shape_id",
        "location_type", "stop_code", "stop_lat", "stop_lon", "stop_name")


@register("J3_trips_left_join_stops", net_sql("ctrips", """
select t.trip_id, t.route_id, x.stop_id, x.stop_sequence
from ctrips t left join (select * from tsc where trip_id in (select trip_id from cand)) x using (trip_id)"""))
def j3(spark, sf):
    codes = nw.trip_stop_codes(tv.stop_times(spark, sf), tv.stops(spark, sf))
    cand = nw.candidate_trips(codes, journeys(spark))
    ct = tv.trips(spark, sf).join(cand, "trip_id", "left_semi")
    return ct.select("trip_id", "route_id").join(
        codes.join(cand, "trip_id", "left_semi").select("trip_id", "stop_id", "stop_sequence"), "trip_id", "left")


@register("J4_on_shape_stops", net_sql("onshape", "select * from onshape"))
def j4(spark, sf):
    f = feed(spark, sf)
    codes = nw.trip_stop_codes(f.stop_times, f.stops)
    cand = nw.candidate_trips(codes, journeys(spark))
    ct = f.trips.join(cand, "trip_id", "left_semi")
    return nw.on_shape_stops(ct, codes.join(cand, "trip_id", "left_semi"), f.stops,
                             f.shapes.join(ct.select("shape_id"), "shape_id", "left_semi"))


@register("D1_distinct_stops", net_sql("cstops", "select * from cstops"))
def d1(spark, sf):
    return refresh(spark, sf).stops


@register("D5_occurrence_match", net_sql("occ", "select * from occ"))
def d5(spark, sf):
    return nw.occurrence_match(j4(spark, sf), journeys(spark))


def _key_stops(spark, sf):
    return nw.key_trips(j4(spark, sf), journeys(spark))


@register("W6_ordered_stop_lists", net_sql("kstops", """
select trip_id, cast(row_number() over (partition by trip_id order by stop_sequence) as int) pos,
       stop_id, stop_code, stop_lat, stop_lon, stop_sequence from kstops"""))
def w6(spark, sf):
    lists = nw.ordered_stops(_key_stops(spark, sf))
    return lists.select("trip_id", F.posexplode("stops").alias("p", "s")).select(
        "trip_id", (F.col("p") + 1).cast("int").alias("pos"), "s.*")


@register("X1_struct_unnest", net_sql("kstops", """
select trip_id, stop_id, stop_code, stop_lat, stop_lon, stop_sequence from kstops"""))
def x1(spark, sf):
    ks = _key_stops(spark, sf)
    return ks.select("trip_id", F.struct(*nw.STOP_FIELDS).alias("stop")).select("trip_id", "stop.*")


@register("X2_list_field", net_sql("kstops", """
select trip_id, string_agg(stop_code, ',' order by stop_sequence) codes from kstops group by trip_id"""))
def x2(spark, sf):
    lists = nw.ordered_stops(_key_stops(spark, sf))
    return lists.select("trip_id", F.array_join(F.col("stops.stop_code"), ",").alias("codes"))


@register("X4_member_count", net_sql("kstops", f"""
select trip_id, cast(count(*) filter (where stop_code in ({', '.join(repr(c) for c in JOURNEYS[0])})) as int) n_members
from kstops group by trip_id"""))
def x4(spark, sf):
    lists = nw.ordered_stops(_key_stops(spark, sf))
    return lists.select("trip_id", nw.member_count(F.col("stops.stop_code"), JOURNEYS[0]).alias("n_members"))


KSEG_COLS = ("trip_id, route_id, service_id, direction_id, shape_id, start_stop, end_stop, start_stop_id, "
             "end_stop_id, start_lat, end_lat, start_lon, end_lon, segment_id")


@register("X5_list_shift_explode", net_sql("kseg", f"select {KSEG_COLS} from kseg"))
def x5(spark, sf):
    """X3 + X5 on lists: shift each field list by one and explode the parallel lists."""
    from ..functions.arrays import shift_left
    from ..functions.strings import segment_id
    lists = nw.ordered_stops(_key_stops(spark, sf))
    s = F.col("stops")
    cols = {"start_stop": s["stop_code"], "start_stop_id": s["stop_id"], "start_lat": s["stop_lat"],
            "start_lon": s["stop_lon"]}
    shifted = {n.replace("start_", "end_"): shift_left(c) for n, c in cols.items()}
    zipped = F.arrays_zip(*[c.alias(n) for n, c in cols.items()], *[c.alias(n) for n, c in shifted.items()])
    out = lists.select("trip_id", "route_id", "service_id", "direction_id", "shape_id", F.inline(zipped))
    return out.where(F.col("end_stop").isNotNull()).withColumn(
        "segment_id", segment_id("start_stop", "end_stop")).select(*[c.strip() for c in KSEG_COLS.split(",")])


@register("C1_key_segments", net_sql("kseg", f"select {KSEG_COLS} from kseg"))
def c1_kseg(spark, sf):
    return refresh(spark, sf).key_segments.select(*[c.strip() for c in KSEG_COLS.split(",")])


@register("W1_next_stop", net_sql("tsc", """
select trip_id, stop_sequence, stop_code, lead(stop_code) over (partition by trip_id order by stop_sequence) end_stop_code
from tsc"""))
def w1(spark, sf):
    codes = nw.trip_stop_codes(tv.stop_times(spark, sf), tv.stops(spark, sf)).select(
        "trip_id", "stop_sequence", "stop_code")
    return nw.next_in_trip(codes, ["stop_code"], {"stop_code": "end_stop_code"})


@register("X6_segment_ids", net_sql("tsc", """
select trip_id, stop_sequence, stop_code || '-' || lead(stop_code) over (partition by trip_id order by stop_sequence) segment_id
from tsc"""))
def x6(spark, sf):
    from ..functions.strings import segment_id
    w1df = w1(spark, sf)
    return w1df.select("trip_id", "stop_sequence", segment_id("stop_code", "end_stop_code").alias("segment_id"))


@register("C1_trip_segments", net_sql("tseg", "select * from tseg"))
def c1_tseg(spark, sf):
    return refresh(spark, sf).trip_segments


@register("D2_unique_segments", net_sql("useg", "select * from useg"))
def d2(spark, sf):
    return refresh(spark, sf).segments


@register("C1_relevant_trips", net_sql("rtrips", "select * from rtrips"))
def c1_trips(spark, sf):
    return refresh(spark, sf).trips


@register("K6_refresh_counts", net_sql("cstops", """
select 'stops' table_name, count(*) n_rows from cstops union all
select 'trips', count(*) from rtrips union all
select 'trip_segments', count(*) from tseg union all
select 'segments', count(*) from useg"""))
def k6(spark, sf):
    return sr.refresh_counts(refresh(spark, sf))


@register("Q3_key_uniqueness", net_sql("cstops", """
select 'calendar' table_name, count(*) n_rows, count(distinct service_id) n_keys, count(*) = count(distinct service_id) ok from calendar
union all select 'stops', count(*), count(distinct stop_id), count(*) = count(distinct stop_id) from cstops
union all select 'trips', count(*), count(distinct trip_id), count(*) = count(distinct trip_id) from rtrips
union all select 'segments', count(*), count(distinct segment_id), count(*) = count(distinct segment_id) from useg
union all select 'trip_segments', count(*), count(distinct (segment_id, trip_id)), count(*) = count(distinct (segment_id, trip_id)) from tseg"""))
def q3(spark, sf):
    r = refresh(spark, sf)
    return qa.unique_report({
        "calendar": (r.calendar, ["service_id"]), "stops": (r.stops, ["stop_id"]), "trips": (r.trips, ["trip_id"]),
        "segments": (r.segments, ["segment_id"]), "trip_segments": (r.trip_segments, ["segment_id", "trip_id"]),
    })


_ROUTES_SQL = ", ".join(f"'{r}'" for r in ROUTES)
EXPLORE = {
    "rtr": f"select * from trips where route_id in ({_ROUTES_SQL})",
    "rcodes": "select * from tsc where trip_id in (select trip_id from rtr)",
    "ronshape": """select distinct t.route_id, t.trip_id, t.service_id, t.direction_id, t.shape_id, x.stop_id,
        x.stop_code, s.stop_lat, s.stop_lon, x.stop_sequence
        from rtr t join rcodes x using (trip_id) join stops s on s.stop_id = x.stop_id
        join shapes sh on sh.shape_id = t.shape_id and sh.shape_pt_lat = s.stop_lat and sh.shape_pt_lon = s.stop_lon""",
    "rocc": """select o.trip_id from ronshape o join (select distinct journey_id, stop_code from journeys) j using (stop_code)
        group by o.trip_id, j.journey_id having count(*) = (select list_size from jsz where jsz.journey_id = j.journey_id)""",
}


def explore_sql(body: str) -> str:
    return with_views("stops", "stop_times", "trips", "shapes", extra={
        **{k: NET[k] for k in ("journeys", "jsz", "tsc")}, **EXPLORE}) + body


@register("C5_route_exploration", explore_sql("""
select distinct route_id, trip_id, service_id, direction_id, shape_id from ronshape
where trip_id in (select trip_id from rocc)"""))
def c5(spark, sf):
    trips_out, _ = sr.explore_route(feed(spark, sf), ROUTES, journeys(spark))
    return trips_out


@register("C5_stop_lists", explore_sql("""
, ks as (select * from ronshape where trip_id in (select trip_id from rocc))
select trip_id, route_id, count(*) n_stops, string_agg(stop_id || ':' || stop_code, ',' order by stop_sequence) stop_list
from ks group by trip_id, route_id"""))
def c5_lists(spark, sf):
    """The ordered stop list of each key trip of the explored routes."""
    _, lists = sr.explore_route(feed(spark, sf), ROUTES, journeys(spark))
    item = F.transform("stops", lambda x: F.concat(x["stop_id"], F.lit(":"), x["stop_code"]))
    return lists.select("trip_id", "route_id", F.size("stops").cast("long").alias("n_stops"), F.array_join(item, ",").alias("stop_list"))


@register("P2_in_list_filter", with_views("trips") + f"select * from trips where route_id in ({_ROUTES_SQL})")
def p2(spark, sf):
    return tv.trips(spark, sf).where(F.col("route_id").isin(ROUTES))
