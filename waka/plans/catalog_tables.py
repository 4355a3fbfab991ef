"""Registered queries: sources (S1-S3, S6, S7), sinks and table maintenance (K1-K5,
M1-M4), trip-table reads (P3, O2, C6), referential checks (Q4) and small operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import network as nw
from ..operators import quality as qa
from ..operators import tables as tb
from ..oracle import with_views
from ..session import materialize, scratch_path
from ..sources import feed_files as ff
from ..sources import transit_views as tv
from ..sources.tables import read_table
from . import catalog_features as cf
from . import catalog_network as cn
from . import catalog_profile as cp
from . import refresh_job as rj
from . import static_refresh as sr
from . import weekly
from .registry import register

# Columns of the stored tables.
STOP_COLS = ["stop_id", "location_type", "stop_code", "stop_lat", "stop_lon", "stop_name"]
TRIP_COLS = ["trip_id", "route_id", "service_id", "direction_id", "shape_id"]


# ------------------------------------------------------------------ S1 / S2 / S3 / S6 / S7
@register("S1_feed_csv_scan", with_views("stops") + "select * from stops")
def s1(spark, sf):
    path = scratch_path(spark, "stops_csv")
    ff.write_feed_csv(tv.stops(spark, sf), path)
    return ff.read_feed_csv(spark, path, "stops", STOP_COLS)


@register("S2_feed_csv_pushdown", cn.net_sql("cand", """
select s.shape_id, s.shape_pt_lat, s.shape_pt_lon from shapes s
where s.shape_id in (select shape_id from trips where trip_id in (select trip_id from cand))"""))
def s2(spark, sf):
    """Lazy CSV scans: stop_times projected to three columns, shapes filtered to the
    candidate trips' shapes (projection and a semi-join filter on the scan side)."""
    st_path, sh_path = scratch_path(spark, "stop_times_csv"), scratch_path(spark, "shapes_csv")
    ff.write_feed_csv(tv.stop_times(spark, sf), st_path)
    ff.write_feed_csv(tv.shapes(spark, sf), sh_path)
    st = ff.read_feed_csv(spark, st_path, "stop_times", ["trip_id", "stop_id", "stop_sequence"])
    codes = nw.trip_stop_codes(st, tv.stops(spark, sf))
    cand = nw.candidate_trips(codes, cn.journeys(spark))
    shapes_wanted = tv.trips(spark, sf).join(cand, "trip_id", "left_semi").select("shape_id")
    sh = ff.read_feed_csv(spark, sh_path, "shapes", ["shape_id", "shape_pt_lat", "shape_pt_lon"])
    return sh.join(shapes_wanted, "shape_id", "left_semi")


#: Columns of each feed member, and what of them identifies a row.
MEMBER_COLS = {
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"],
    "stops": STOP_COLS, "stop_times": ["trip_id", "stop_id", "stop_sequence"], "trips": TRIP_COLS,
    "shapes": ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"], "routes": ["route_id"],
}
_SCALED = {"stop_lat", "stop_lon", "shape_pt_lat", "shape_pt_lon"}      # compared in millionths of a degree


@register("S3_feed_zip_members", with_views("calendar", "stops", "stop_times", "trips", "shapes", extra={
    "routes": "select distinct route_id from trips"}) + " union all ".join(
    f"select '{m}' as member, concat_ws('|', " + ", ".join(f"cast(round({c} * 1000000) as bigint)" if c in _SCALED else c for c in cols) + f") as row_text from {m}"
    for m, cols in MEMBER_COLS.items()))
def s3(spark, sf):
    """All six members of a feed: packed into part archives by the tasks that hold the rows, landed, unpacked and typed again."""
    tables = {"calendar": tv.calendar(spark, sf), "stops": tv.stops(spark, sf), "stop_times": tv.stop_times(spark, sf), "trips": tv.trips(spark, sf),
              "shapes": tv.shapes(spark, sf), "routes": tv.trips(spark, sf).select("route_id").distinct()}
    packed = [ff.pack_member(tables[m].select(*cols), m, part_rows=20_000) for m, cols in MEMBER_COLS.items()]
    landed = materialize(reduce(lambda a, b: a.unionByName(b), packed), "feed_archives")
    text = lambda c: F.round(F.col(c) * 1000000).cast("long") if c in _SCALED else F.col(c)
    rows = [ff.feed_rows(landed, m, cols).select(F.lit(m).alias("member"), F.concat_ws("|", *[text(c) for c in cols]).alias("row_text"))
            for m, cols in MEMBER_COLS.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


@register("S6_parametrised_sql", with_views("vehicle_locations") + f"""
select id, "timestamp", trip_id, speed from vehicle_locations where "timestamp" >= {cf.LO} and "timestamp" < {cf.HI}""")
def s6(spark, sf):
    """Parameters bound by name; the bounds of the date prune the stored table's partitions."""
    return spark.sql("""select id, `timestamp`, trip_id, speed from identifier(:locations)
                        where `timestamp` >= :lo and `timestamp` < :hi
                          and obs_date between date(timestamp_seconds(:lo)) and date(timestamp_seconds(:hi - 1))""",
                     args={"locations": cf.stored_locations(spark, sf), "lo": cf.LO, "hi": cf.HI})


@register("S7_json_documents", cn.net_sql("kstops", """
select trip_id, stop_id, stop_code, stop_lat, stop_lon, stop_sequence from kstops"""))
def s7(spark, sf):
    """Each key trip's ordered stop list as a JSON document of its own, a line of the files that the tasks write (with the trip
    before it), and read back."""
    lists = nw.ordered_stops(cn._key_stops(spark, sf))
    path = scratch_path(spark, "stop_lists")
    lists.select(F.concat_ws("\t", "trip_id", F.to_json("stops"))).write.text(path)
    back = ff.read_json_lines(spark, path, "stop_id string, stop_code string, stop_lat double, stop_lon double, stop_sequence int")
    return back.select(F.col("name").alias("trip_id"), "stop_id", "stop_code", "stop_lat", "stop_lon", "stop_sequence")


# ------------------------------------------------------------------ K1-K6
LOC_KEYS = ["id", "timestamp"]
SPLIT_TS = "2024-01-15"   # first batch: before; second batch: from OVERLAP_TS on (overlapping)
OVERLAP_TS = "2024-01-10"


@register("K1_insert_ignore", with_views("vehicle_locations") + f"""
, old as (select id, "timestamp", trip_id, speed from vehicle_locations where ts < timestamp '{SPLIT_TS}'),
new as (select id, "timestamp", trip_id, speed + 1000 speed from vehicle_locations where ts >= timestamp '{OVERLAP_TS}')
select * from old union all select * from new where (id, "timestamp") not in (select (id, "timestamp") from old)""")
def k1(spark, sf):
    loc = tv.vehicle_locations(spark, sf).withColumn("obs_date", F.to_date(F.timestamp_seconds("timestamp")))
    cols = ["id", "timestamp", "trip_id", "speed", "obs_date"]
    old = loc.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")).select(*cols)
    new = loc.where(F.col("ts") >= F.lit(OVERLAP_TS).cast("timestamp_ntz")).select(
        "id", "timestamp", "trip_id", (F.col("speed") + 1000).alias("speed"), "obs_date")
    path = scratch_path(spark, "vehicle_locations")
    keys = ["obs_date", *LOC_KEYS]
    tb.append_new_rows(spark, path, old, keys, partition_by=["obs_date"])
    tb.append_new_rows(spark, path, new, keys, partition_by=["obs_date"])
    tb.append_new_rows(spark, path, new, keys, partition_by=["obs_date"])   # replay: no-op
    return spark.read.parquet(path).select("id", "timestamp", "trip_id", "speed")


@register("K2_upsert", with_views("trips", extra={"rt": "select distinct event_type trip_id from events"}) + """
, upd as (select trip_id, 'R-new' route_id, service_id, direction_id, shape_id from trips
          where trip_id in (select cast(o_orderkey as varchar) from orders where o_orderstatus = 'F')
          union all select trip_id, 'RT', 'SV5', 0, 'SH0' from rt)
select *, cast(100 as bigint) created_at from trips where trip_id not in (select trip_id from upd)
union all select *, cast(200 as bigint) from upd""")
def k2(spark, sf):
    trips = tv.trips(spark, sf)
    f_orders = read_table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("string").alias("trip_id"))
    upd = trips.join(f_orders, "trip_id", "left_semi").withColumn("route_id", F.lit("R-new"))
    rt_trips = tv.realtime_trips(spark, sf).select("trip_id", F.lit("RT").alias("route_id"),
                                                   F.lit("SV5").alias("service_id"), F.lit(0).alias("direction_id"),
                                                   F.lit("SH0").alias("shape_id"))
    old = trips.withColumn("created_at", F.lit(100).cast("long"))
    return tb.upsert(old, upd.unionByName(rt_trips), ["trip_id"], stamp=("created_at", 200))


@register("K2_upsert_all_key_table", with_views("trip_segments", "segments") + """
select distinct * from (select * from trip_segments union all
  select trip_id, segment_id from trip_segments where segment_id = '0-1') q""")
def k2b(spark, sf):
    ts = tv.trip_segments(spark, sf)
    again = ts.where(F.col("segment_id") == "0-1")
    return tb.upsert(ts, again, ["trip_id", "segment_id"])


@register("K3_partitioned_upsert", cp.sql(f"""
select id, "timestamp", obs_year, segment_id, case when "timestamp" between {cf.LO} and {cf.HI - 1} and id % 2 = 0 then speed + 1000 else speed end speed
from tr"""))
def k3(spark, sf):
    """The training sets of all weeks, then new values for half of the rows of one week: its other rows and the other weeks stay."""
    root = scratch_path(spark, "analytics_data")
    ts = cp.train(spark, sf)
    weekly.upsert_week(spark, root, ts)
    again = ts.where(F.col("timestamp").between(cf.LO, cf.HI - 1) & (F.col("id") % 2 == 0)).withColumn("speed", F.col("speed") + 1000)
    weekly.upsert_week(spark, root, again)
    return weekly.stored_training_set(spark, root).select("id", "timestamp", "obs_year", "segment_id", "speed")


@register("K4_json_csv_export", cn.explore_sql("""
select distinct route_id, trip_id, service_id, direction_id, shape_id from ronshape
where trip_id in (select trip_id from rocc)"""))
def k4(spark, sf):
    trips_out, lists = sr.explore_route(cn.feed(spark, sf), cn.ROUTES, cn.journeys(spark))
    jpath, cpath = scratch_path(spark, "work_trips_json"), scratch_path(spark, "trips_csv")
    work = trips_out.join(lists.select("trip_id", "stops"), "trip_id")
    work.write.mode("overwrite").json(jpath)
    # the schema is given: JSON without a row, or with a field that is null in all rows, has nothing to infer it from
    spark.read.schema(work.schema).json(jpath).drop("stops").write.mode("overwrite").option("header", True).csv(cpath)
    return ff.read_feed_csv(spark, cpath, "trips", TRIP_COLS)


_SIZES_SQL = """
select 'calendar' table_name, count(*) n_rows from calendar union all
select 'stops', count(*) from cstops union all select 'trips', count(*) from rtrips union all
select 'segments', count(*) from useg union all select 'trip_segments', count(*) from tseg"""


@register("K5_publish_refresh", cn.net_sql("cstops", _SIZES_SQL))
def k5(spark, sf):
    root = scratch_path(spark, "static")
    rj.publish_refresh(spark, root, rj.tables_of(cn.refresh(spark, sf)), at=100)
    return rj.table_sizes(spark, root)


def _two_refreshes(spark, sf):
    """Two refreshes from feeds that differ: the first lacks trips and stops, the second lacks others and has some
    changed. Returns the root and the report of the second."""
    tables = {n: materialize(df, n) for n, df in rj.tables_of(cn.refresh(spark, sf)).items()}
    trip, stop = F.col("trip_id").cast("long"), F.substring("stop_id", 2, 30).cast("long")
    first = tables | {"trips": tables["trips"].where(trip % 3 != 0), "stops": tables["stops"].where(stop % 3 != 0)}
    second = tables | {
        "trips": tables["trips"].where(trip % 5 != 0).withColumn("route_id", F.when(trip % 7 == 0, F.lit("R-new")).otherwise(F.col("route_id"))),
        "stops": tables["stops"].where(stop % 5 != 0).withColumn("stop_name", F.when(stop % 7 == 0, F.lit("new")).otherwise(F.col("stop_name")))}
    root = scratch_path(spark, "static")
    rj.publish_refresh(spark, root, first, at=100)
    return root, rj.publish_refresh(spark, root, second, at=200)


_FEEDS_SQL = """
, t1 as (select * from rtrips where cast(trip_id as bigint) % 3 <> 0),
t2 as (select * replace (case when cast(trip_id as bigint) % 7 = 0 then 'R-new' else route_id end as route_id)
       from rtrips where cast(trip_id as bigint) % 5 <> 0),
s1 as (select * from cstops where cast(substr(stop_id, 2) as bigint) % 3 <> 0),
s2 as (select * replace (case when cast(substr(stop_id, 2) as bigint) % 7 = 0 then 'new' else stop_name end as stop_name)
       from cstops where cast(substr(stop_id, 2) as bigint) % 5 <> 0)"""


@register("T5_static_refresh", cn.net_sql("cstops", _FEEDS_SQL + """
select *, cast(200 as bigint) created_at from t2
union all select *, cast(100 as bigint) from t1 where trip_id not in (select trip_id from t2)"""))
def t5(spark, sf):
    """The trips of the published version after two refreshes (C1, Q3, K2, K5): rows of the last feed, and rows it lacks kept."""
    root, _ = _two_refreshes(spark, sf)
    return rj.read_refreshed(spark, root, "trips")


def _changes_sql(name: str, a: str, b: str, key: str, value: str) -> str:
    pair = f"select count(*) from {b} n join {a} o using ({key}) where n.{value}"
    return (f"select '{name}' table_name, (select count(*) from {b} where {key} not in (select {key} from {a})) n_new, "
            f"({pair} <> o.{value}) n_changed, (select count(*) from {a} where {key} not in (select {key} from {b})) n_gone, "
            f"({pair} = o.{value}) n_same")


@register("T5_refresh_changes", cn.net_sql("cstops", _FEEDS_SQL + "\n" + " union all ".join([
    _changes_sql("trips", "t1", "t2", "trip_id", "route_id"), _changes_sql("stops", "s1", "s2", "stop_id", "stop_name"),
    *[f"select '{n}', 0, 0, 0, (select count(*) from {v})" for n, v in (("calendar", "calendar"), ("segments", "useg"), ("trip_segments", "tseg"))]])))
def t5_changes(spark, sf):
    """What the second refresh found, per table, by key and digest."""
    _, report = _two_refreshes(spark, sf)
    return report.drop("n_rewritten")


# ------------------------------------------------------------------ M1-M4, P3, O2, C6
@register("M1_create_trips", with_views("trips") + """
select * from trips union all
select distinct event_type, concat('R', length(event_type)), concat('SV', length(event_type) % 25),
       cast(length(event_type) % 2 as int), concat('SH', length(event_type) % 10) from events""")
def m1(spark, sf):
    return tb.create_rows(tv.trips(spark, sf), tv.realtime_trips(spark, sf), ["trip_id"])


@register("M2_get_trips", with_views("trips") + """
select r.trip_id, t.route_id, t.service_id, t.direction_id, t.shape_id from
  (select distinct cast(l_orderkey as varchar) trip_id from lineitem union select distinct event_type from events) r
  left join trips t using (trip_id)""")
def m2(spark, sf):
    req = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("trip_id")).unionByName(
        read_table(spark, sf, "events").select(F.col("event_type").alias("trip_id")))
    return tb.get_rows(tv.trips(spark, sf), req, ["trip_id"]).select(*TRIP_COLS)


@register("M3_update_trips", with_views("trips") + """
, u as (select cast(o_orderkey as varchar) trip_id, 'R-upd' route_id, 'SV1' service_id, 1 direction_id, 'SH1' shape_id
        from orders where o_orderpriority = '1-URGENT')
select t.trip_id, case when u.trip_id is not null then u.route_id else t.route_id end route_id,
       case when u.trip_id is not null then u.service_id else t.service_id end service_id,
       case when u.trip_id is not null then u.direction_id else t.direction_id end direction_id,
       case when u.trip_id is not null then u.shape_id else t.shape_id end shape_id, u.trip_id is not null updated
from trips t left join u using (trip_id)""")
def m3(spark, sf):
    u = read_table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").cast("string").alias("trip_id"), F.lit("R-upd").alias("route_id"),
        F.lit("SV1").alias("service_id"), F.lit(1).alias("direction_id"), F.lit("SH1").alias("shape_id"))
    return tb.update_rows(tv.trips(spark, sf), u, ["trip_id"])


@register("M3_update_report", with_views("trips") + """
, u as (select distinct cast(o_orderkey as varchar) trip_id from orders where o_orderpriority = '1-URGENT'
        union select distinct event_type from events)
select u.trip_id, u.trip_id in (select trip_id from trips) as found from u""")
def m3_report(spark, sf):
    """Which of the requested trips an update found."""
    asked = read_table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").cast("string").alias("trip_id")).unionByName(tv.realtime_trips(spark, sf).select("trip_id"))
    return tb.update_report(tv.trips(spark, sf), asked, ["trip_id"])


_DELETE_SQL = """
, alltrips as (select * from trips union all
  select distinct event_type, concat('R', length(event_type)), concat('SV', length(event_type) % 25),
         cast(length(event_type) % 2 as int), concat('SH', length(event_type) % 10) from events),
req as (select cast(o_orderkey as varchar) trip_id from orders where o_orderstatus = 'P'
        union select distinct event_type from events union select distinct 'missing-' || event_type from events)"""


@register("M4_delete_report", with_views("trips", "vehicle_locations") + _DELETE_SQL + """
select trip_id, trip_id in (select trip_id from alltrips) as found,
       trip_id in (select trip_id from alltrips) and trip_id not in (select trip_id from vehicle_locations) as deleted from req""")
def m4_report(spark, sf):
    """For each requested trip, whether it was found and whether it was deleted (trips still referred to are not)."""
    rt = tv.realtime_trips(spark, sf)
    table = tv.trips(spark, sf).unionByName(rt)
    asked = read_table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").cast("string").alias("trip_id")).unionByName(rt.select("trip_id")).unionByName(
        rt.select(F.concat(F.lit("missing-"), "trip_id").alias("trip_id")))
    return tb.delete_rows(table, asked, "trip_id", restrict=[tv.vehicle_locations(spark, sf)])[1]


@register("M4_delete_trips", with_views("trips", "vehicle_locations") + """
, alltrips as (select * from trips union all
  select distinct event_type, concat('R', length(event_type)), concat('SV', length(event_type) % 25),
         cast(length(event_type) % 2 as int), concat('SH', length(event_type) % 10) from events),
req as (select cast(o_orderkey as varchar) trip_id from orders where o_orderstatus = 'P'
        union select distinct event_type from events),
del as (select trip_id from req where trip_id in (select trip_id from alltrips)
        and trip_id not in (select trip_id from vehicle_locations))
select * from alltrips where trip_id not in (select trip_id from del)""")
def m4(spark, sf):
    table = tv.trips(spark, sf).unionByName(tv.realtime_trips(spark, sf))
    req = read_table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").cast("string").alias("trip_id")).unionByName(
        tv.realtime_trips(spark, sf).select("trip_id"))
    remaining, report = tb.delete_rows(table, req, "trip_id", restrict=[tv.vehicle_locations(spark, sf)])
    return remaining


@register("M4_delete_cascade", with_views("trip_segments", "segments") + """
select * from trip_segments where trip_id not in ('click', 'view')""")
def m4b(spark, sf):
    ts = tv.trip_segments(spark, sf)
    table = tv.realtime_trips(spark, sf)
    req = table.where(F.col("trip_id").isin("click", "view")).select("trip_id")
    _, report = tb.delete_rows(table, req, "trip_id")
    return tb.cascade(ts, report, "trip_id")


@register("P3_optional_list_filters", with_views("trips") + """
select * from trips where route_id in ('R1', 'R3') and direction_id in (1)""")
def p3(spark, sf):
    return tb.filter_lists(tv.trips(spark, sf), route_id=" R1, R3 ", service_id=None, direction_id=1, shape_id=None)


@register("X7_split_trim", with_views("trips") + """
select trip_id, list_transform(string_split(route_id || ' , ' || shape_id, ','), lambda x: trim(x)) items from trips""")
def x7(spark, sf):
    from ..functions.strings import split_trim
    t = tv.trips(spark, sf)
    return t.select("trip_id", split_trim(F.concat("route_id", F.lit(" , "), "shape_id")).alias("items"))


@register("O2_order_offset_limit", with_views("trips") + "select * from trips order by trip_id limit 50 offset 100")
def o2(spark, sf):
    return tb.page(tv.trips(spark, sf), ["trip_id"], offset=100, limit=50)


@register("C6_trip_table_read", with_views("trips") + """
select * from trips where route_id in ('R1', 'R3') and service_id in ('SV1', 'SV3', 'SV11') and direction_id in (0, 1)
order by trip_id limit 25 offset 5""")
def c6(spark, sf):
    t = tb.filter_lists(tv.trips(spark, sf), route_id="R1,R3", service_id="SV1, SV3,SV11", direction_id="0,1")
    return tb.page(t, ["trip_id"], offset=5, limit=25)


@register("Q4_referential_integrity", with_views("trips", "calendar", "vehicle_locations", "segments", "stops",
                                                  "trip_segments") + """
, rt as (select distinct event_type trip_id from events)
select 'trips.service_id' fk, count(*) orphans from trips where service_id not in (select service_id from calendar)
union all select 'vehicle_locations.trip_id', count(*) from vehicle_locations where trip_id not in (select trip_id from rt)
union all select 'segments.start_stop_id', count(*) from segments where start_stop_id not in (select stop_id from stops)
union all select 'segments.end_stop_id', count(*) from segments where end_stop_id not in (select stop_id from stops)
union all select 'trip_segments.trip_id', count(*) from trip_segments where trip_id not in (select trip_id from rt)
union all select 'trip_segments.segment_id', count(*) from trip_segments where segment_id not in (select segment_id from segments)""")
def q4(spark, sf):
    trips, cal = tv.trips(spark, sf), tv.calendar(spark, sf)
    rt = tv.realtime_trips(spark, sf)
    seg, stops, ts = tv.segments(spark, sf), tv.stops(spark, sf), tv.trip_segments(spark, sf)
    parts = [
        qa.orphans(trips, cal, ["service_id"], name="trips.service_id"),
        qa.orphans(tv.vehicle_locations(spark, sf), rt, ["trip_id"], name="vehicle_locations.trip_id"),
        qa.orphans(seg, stops, ["start_stop_id"], ["stop_id"], name="segments.start_stop_id"),
        qa.orphans(seg, stops, ["end_stop_id"], ["stop_id"], name="segments.end_stop_id"),
        qa.orphans(ts, rt, ["trip_id"], name="trip_segments.trip_id"),
        qa.orphans(ts, seg, ["segment_id"], name="trip_segments.segment_id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
