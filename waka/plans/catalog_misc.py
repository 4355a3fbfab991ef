"""Registered queries: remaining single operators (filters, joins, sorts, scalar
functions) and the composed profile table (C4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.geo import point, point_wkt
from ..operators import network as nw
from ..operators import profile as pr
from ..oracle import with_views
from ..sources import transit_views as tv
from . import catalog_network as cn
from . import catalog_profile as cp
from .registry import register, round_doubles


@register("P4_like_filter", with_views("trips") + "select * from trips where route_id like '%5%' or shape_id like '%65%'")
def p4(spark, sf):
    t = tv.trips(spark, sf)
    return t.where(F.col("route_id").like("%5%") | F.col("shape_id").like("%65%"))


@register("P5_not_null_filter", with_views("vehicle_locations") + """
select id, "timestamp", bearing, occupancy_status from vehicle_locations where bearing is not null and occupancy_status is not null""")
def p5(spark, sf):
    loc = tv.vehicle_locations(spark, sf)
    return loc.where(F.col("bearing").isNotNull() & F.col("occupancy_status").isNotNull()).select(
        "id", "timestamp", "bearing", "occupancy_status")


@register("P7_or_of_predicates", cn.net_sql("onshape", """
select distinct trip_id from onshape where stop_code in ('3', '7') or stop_code in ('11', '13')"""))
def p7(spark, sf):
    on = cn.j4(spark, sf)
    preds = [F.col("stop_code").isin(["3", "7"]), F.col("stop_code").isin(["11", "13"])]
    return on.where(reduce(lambda a, b: a | b, preds)).select("trip_id").distinct()


@register("P8_equality_filter", with_views("calendar") + "select service_id from calendar where saturday = 1")
def p8(spark, sf):
    return tv.calendar(spark, sf).where(F.col("saturday") == 1).select("service_id")


@register("O1_multi_key_sort", cn.net_sql("kstops", """
select trip_id, stop_sequence, stop_code,
       row_number() over (partition by trip_id order by stop_sequence) position_in_trip from kstops"""))
def o1(spark, sf):
    """Output sorted by (trip_id, stop_sequence): a range-partitioned global sort; the
    position within the trip is a window per trip (bounded by its schedule)."""
    from pyspark.sql.window import Window
    ks = cn._key_stops(spark, sf)
    pos = F.row_number().over(Window.partitionBy("trip_id").orderBy("stop_sequence"))
    return ks.select("trip_id", "stop_sequence", "stop_code", pos.alias("position_in_trip")).orderBy(
        "trip_id", "stop_sequence")


@register("O5_newest_first", with_views("vehicle_locations") + """
select id, "timestamp", trip_id from vehicle_locations order by "timestamp" desc, id desc limit 10""")
def o5(spark, sf):
    return tv.vehicle_locations(spark, sf).orderBy(F.desc("timestamp"), F.desc("id")).limit(10).select(
        "id", "timestamp", "trip_id")


@register("A1_stop_codes_per_trip", cn.net_sql("tsc", """
select trip_id, count(*) n_stops, string_agg(stop_code, ',' order by stop_sequence) codes from tsc group by trip_id"""))
def a1(spark, sf):
    codes = nw.trip_stop_codes(tv.stop_times(spark, sf), tv.stops(spark, sf))
    g = codes.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("stop_sequence", "stop_code"))).alias("l"))
    return g.select("trip_id", F.size("l").cast("long").alias("n_stops"),
                    F.array_join(F.transform("l", lambda x: x["stop_code"]), ",").alias("codes"))


@register("J9_two_aliased_joins", with_views("segments", "stops") + """
select s.*, st.stop_name start_stop_name, en.stop_name end_stop_name
from segments s join stops st on st.stop_id = s.start_stop_id join stops en on en.stop_id = s.end_stop_id""")
def j9(spark, sf):
    seg, stops = tv.segments(spark, sf), tv.stops(spark, sf)
    st = stops.select(F.col("stop_id").alias("start_stop_id"), F.col("stop_name").alias("start_stop_name"))
    en = stops.select(F.col("stop_id").alias("end_stop_id"), F.col("stop_name").alias("end_stop_name"))
    return seg.join(st, "start_stop_id").join(en, "end_stop_id").select(
        "segment_id", "start_stop_id", "end_stop_id", "start_stop_name", "end_stop_name")


@register("J11_differently_named_keys", with_views("vehicle_locations", "trip_segments", "segments") + """
select vl.id, vl."timestamp", w.segment_id from vehicle_locations vl
join (select ts.trip_id, s.segment_id, s.start_stop_id from trip_segments ts join segments s using (segment_id)) w
  on vl.trip_id = w.trip_id and vl.stop_id = w.start_stop_id""")
def j11(spark, sf):
    loc = tv.vehicle_locations(spark, sf)
    w = tv.trip_segments(spark, sf).join(tv.segments(spark, sf), "segment_id").select(
        F.col("trip_id").alias("w_trip_id"), "segment_id", "start_stop_id")
    j = loc.join(w, (loc.trip_id == w.w_trip_id) & (loc.stop_id == w.start_stop_id))
    return j.select("id", "timestamp", "segment_id")


@register("X15_lenient_cast", with_views("stops") + """
select stop_id, try_cast(stop_name as int) name_as_int, try_cast(stop_code as int) code_as_int from stops""")
def x15(spark, sf):
    s = tv.stops(spark, sf)
    return s.select("stop_id", F.col("stop_name").try_cast("int").alias("name_as_int"),
                    F.col("stop_code").try_cast("int").alias("code_as_int"))


@register("X18_point", with_views("stops") + """
select stop_id, stop_lon lon, stop_lat lat, format('POINT({} {})', stop_lon, stop_lat) wkt from stops""")
def x18(spark, sf):
    s = tv.stops(spark, sf)
    p = point("stop_lon", "stop_lat")
    return s.select("stop_id", p["lon"].alias("lon"), p["lat"].alias("lat"), point_wkt("stop_lon", "stop_lat").alias("wkt"))


@register("X19_labels", cp.sql("""
select day_of_week, ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][day_of_week + 1] label, count(*) n,
       sum(case when "1_lag_delay" >= 0 then 1 else 0 end) n_non_negative from tr group by day_of_week"""))
def x19(spark, sf):
    t = cp.train(spark, sf)
    return t.groupBy("day_of_week").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("1_lag_delay") >= 0, 1).otherwise(0)).alias("n_non_negative")).select(
        "day_of_week", pr.dow_label("day_of_week").alias("label"), "n", "n_non_negative")


@register("X20_record_envelope", with_views("stops") + """
select stop_id, stop_code, stop_name, stop_lat, stop_lon from stops""")
def x20(spark, sf):
    """Single-record ``data.attributes`` envelopes (one per stop) parsed back to rows."""
    from ..functions.jsonpath import envelope_attributes
    s = tv.stops(spark, sf)
    doc = F.to_json(F.struct(F.struct(F.lit("stop").alias("type"), F.col("stop_id").alias("id"),
                                      F.struct("stop_code", "stop_name", "stop_lat", "stop_lon").alias("attributes")
                                      ).alias("data")))
    parsed = envelope_attributes(s.select(doc.alias("value")), "value",
                                 "stop_code string, stop_name string, stop_lat double, stop_lon double", id_col="stop_id")
    return parsed.select("stop_id", "stop_code", "stop_name", "stop_lat", "stop_lon")
