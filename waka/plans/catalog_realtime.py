"""Registered queries: realtime ingest (C2) and its operators, service days."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import FEED_TZ, local_start, week_end
from ..operators import realtime as rt
from ..operators import service as sv
from ..oracle import with_views
from ..sources import realtime_feed as rf
from ..sources import transit_views as tv
from . import ingest as ing
from .registry import register

# Public holidays of 2024 in the feed's region (an input table of dates).
HOLIDAYS_2024 = ["2024-01-01", "2024-01-02", "2024-02-06", "2024-03-29", "2024-04-01", "2024-04-25",
                 "2024-06-03", "2024-06-28", "2024-10-28", "2024-12-25", "2024-12-26"]
SUNDAY = "2024-01-07"


def holidays(spark):
    return spark.createDataFrame([(d,) for d in HOLIDAYS_2024], "holiday string").select(
        F.col("holiday").cast("date").alias("holiday"))


_HOL_SQL = "select cast(h as date) holiday from (values " + ", ".join(f"('{d}')" for d in HOLIDAYS_2024) + ") v(h)"

# ------------------------------------------------------------------ SQL: the events as the feeds carry them
EV = {
    "ev": """select event_id, user_id, event_type, value, ts, cast(floor(epoch(ts)) as bigint) epoch,
        cast(json_extract_string(props, '$.k') as int) k, event_id // 50 tick_no, cast(event_id % 50 as bigint) pos
        from events""",
    "hdr": "select tick_no, max(epoch) tick from ev group by tick_no",
    "e2": """select ev.*, hdr.tick,
        cast(epoch(timezone('Pacific/Auckland', date_trunc('hour', ts))) as bigint) start_epoch from ev join hdr using (tick_no)""",
    "pos_rows": """select tick, pos, user_id id, event_type trip_id,
        case when k % 3 <> 0 then cast(k % 6 as bigint) end occupancy_status,
        case when k % 5 <> 0 then cast((user_id * 37) % 360 as double) end bearing,
        -36.9e0 + (event_id % 97) / 970e0 latitude, 174.7e0 + (event_id % 89) / 890e0 longitude,
        case when event_id % 37 <> 0 then value end speed, epoch "timestamp",
        case when event_id % 53 <> 0 then start_epoch end start_epoch,
        concat('R', length(event_type)) route_id, cast(user_id % 2 as bigint) direction_id,
        event_id % 37 <> 0 and event_id % 53 <> 0 valid
        from e2 where event_id % 41 <> 0""",
    "upd_rows": """select tick, pos, event_type trip_id, false is_deleted, cast(0 as bigint) schedule_relationship,
        case when not (k % 3 = 2 and event_id % 7 = 0) then cast(user_id % 10 as bigint) end stop_sequence,
        case when not (k % 3 = 2 and event_id % 7 = 0) then concat('S', user_id % 10) end stop_id,
        case when not (k % 3 = 2 and event_id % 7 = 0) then cast(0 as bigint) end stop_schedule_relationship,
        case when k % 2 = 1 and not (k % 3 = 2 and event_id % 7 = 0) then cast(k as bigint) end departure_delay,
        case when k % 2 = 1 and not (k % 3 = 2 and event_id % 7 = 0) then epoch + 60 end departure_time,
        case when k % 2 = 1 and not (k % 3 = 2 and event_id % 7 = 0) then cast(0 as bigint) end departure_uncertainty,
        cast(user_id as varchar) vehicle_id, case when event_id % 31 <> 0 then concat('L', user_id) end label,
        concat('P', user_id) license_plate, epoch "timestamp", cast(floor(value) as bigint) - 20 delay,
        case when event_id % 53 <> 0 then start_epoch end start_epoch,
        concat('R', length(event_type)) route_id, cast(user_id % 2 as bigint) direction_id,
        event_id % 53 <> 0 and not (k % 3 = 2 and event_id % 7 = 0) valid
        from e2""",
    "hol": _HOL_SQL,
    "rtrips": """select distinct event_type trip_id, concat('SV', length(event_type) % 25) service_id from events""",
    "cal_long": """unpivot calendar on monday, tuesday, wednesday, thursday, friday, saturday, sunday
        into name day_name value runs""",
    "tick_day": """select distinct tick, case when d in (select holiday from hol) then 'sunday' else lower(dayname(d)) end day_name
        from (select tick, cast(timezone('Pacific/Auckland', to_timestamp(tick)) as date) d from hdr) q""",
    "active": """select t.tick, r.trip_id from tick_day t join cal_long c on c.day_name = t.day_name and c.runs = 1
        join rtrips r on r.service_id = c.service_id""",
    "lp": """select * from (select *, row_number() over (partition by tick, trip_id order by pos desc) rn
        from pos_rows where valid and (tick, trip_id) in (select tick, trip_id from active)) q where rn = 1""",
    "lu": """select * from (select *, row_number() over (partition by tick, trip_id order by pos desc) rn
        from upd_rows where valid and (tick, trip_id) in (select tick, trip_id from active)) q where rn = 1""",
    "merged": """select lp.tick, lp.pos, lp.id, lp.trip_id, lp.occupancy_status, lp.bearing, lp.latitude, lp.longitude,
        lp.speed, lp."timestamp", lp.start_epoch, lp.route_id, lp.direction_id, lu.is_deleted, lu.schedule_relationship,
        lu.stop_sequence, lu.stop_id, lu.stop_schedule_relationship, lu.departure_delay, lu.departure_time,
        lu.departure_uncertainty, lu.vehicle_id, lu.label, lu.license_plate, lu.delay
        from lp join lu using (tick, trip_id)""",
    "loc": """select * exclude (rn) from (select *, row_number() over (partition by id, "timestamp" order by tick, pos) rn
        from merged where vehicle_id is not null and label is not null) q where rn = 1""",
}


def ev_sql(upto: str, body: str, views=("calendar",)) -> str:
    names = list(EV)[: list(EV).index(upto) + 1]
    return with_views(*views, extra={k: EV[k] for k in names}) + body


def _present(df):
    """Timestamps leave as epoch seconds (engine-neutral)."""
    return df.withColumn("start_epoch", F.unix_seconds("start_time")).drop("start_time")


POS_OUT = ["tick", "pos", "id", "trip_id", "occupancy_status", "bearing", "latitude", "longitude", "speed",
           "timestamp", "start_epoch", "route_id", "direction_id"]


@register("S4_position_parse", ev_sql("pos_rows", f"select {', '.join(chr(34) + c + chr(34) for c in POS_OUT)}, valid from pos_rows"))
def s4(spark, sf):
    df, rules = rf.parse_positions(rf.position_documents(spark, sf))
    ok = F.lit(True)
    for r in rules.values():
        ok = ok & r
    return _present(df).select(*POS_OUT, ok.alias("valid"))


UPD_OUT = ["tick", "pos", "trip_id", "is_deleted", "schedule_relationship", "stop_sequence", "stop_id",
           "stop_schedule_relationship", "departure_delay", "departure_time", "departure_uncertainty", "vehicle_id",
           "label", "license_plate", "timestamp", "delay", "start_epoch", "route_id", "direction_id"]


@register("S5_update_parse", ev_sql("upd_rows", f"select {', '.join(chr(34) + c + chr(34) for c in UPD_OUT)}, valid from upd_rows"))
def s5(spark, sf):
    df, rules = rf.parse_updates(rf.update_documents(spark, sf))
    ok = F.lit(True)
    for r in rules.values():
        ok = ok & r
    return _present(df).select(*UPD_OUT, ok.alias("valid"))


@register("P12_active_entity_filter", ev_sql("e2", "select count(*) n_entities from e2 where event_id % 41 <> 0"))
def p12(spark, sf):
    df, _ = rf.parse_positions(rf.position_documents(spark, sf))
    return df.agg(F.count(F.lit(1)).alias("n_entities"))


@register("Q5_quarantine_counts", ev_sql("upd_rows", """
select 'positions' feed, count(*) filter (where valid) n_valid, count(*) filter (where not valid) n_rejected from pos_rows
union all select 'updates', count(*) filter (where valid), count(*) filter (where not valid) from upd_rows"""))
def q5(spark, sf):
    out = None
    for name, docs, parse, cols in [("positions", rf.position_documents, rf.parse_positions, ing.POSITION_OUT),
                                    ("updates", rf.update_documents, rf.parse_updates, ing.UPDATE_OUT)]:
        # stored by valid_feed: a filter on computed errors is pushed down and computes every field many times
        good, bad = ing.valid_feed(docs(spark, sf), parse, cols, name)
        one = good.agg(F.count(F.lit(1)).alias("n_valid")).select(
            F.lit(name).alias("feed"), "n_valid", bad.select(F.count(F.lit(1))).scalar().alias("n_rejected"))
        out = one if out is None else out.unionByName(one)
    return out


@register("X9_local_start_time", ev_sql("e2", """
select event_id, case when event_id % 53 <> 0 then start_epoch end start_epoch from e2"""))
def x9(spark, sf):
    e = rf._events(spark, sf)
    bad = F.col("event_id") % 53 == 0
    st = F.when(bad, F.lit("25:10:00")).otherwise(F.date_format(F.col("ts").cast("timestamp"), "H:00:00"))
    sd = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd")
    return e.select("event_id", F.unix_seconds(local_start(sd, st, FEED_TZ)).alias("start_epoch"))


@register("X16_X17_lenient_fields", ev_sql("pos_rows", """
select tick, pos, id, bearing, occupancy_status from pos_rows"""))
def x16(spark, sf):
    df, _ = rf.parse_positions(rf.position_documents(spark, sf))
    return df.select("tick", "pos", "id", "bearing", "occupancy_status")


@register("D3_last_valid_per_trip", ev_sql("lp", """select tick, trip_id, pos, id, "timestamp" from lp"""))
def d3(spark, sf):
    gp, _ = ing.valid_feed(rf.position_documents(spark, sf), rf.parse_positions, ing.POSITION_OUT, "positions")
    act = ing.keep_active(gp, tv.realtime_trips(spark, sf), tv.calendar(spark, sf), holidays(spark))
    return rt.last_per_trip(act).select("tick", "trip_id", "pos", "id", "timestamp")


@register("J10_feed_merge", ev_sql("merged", """select tick, trip_id, id, "timestamp", stop_id, delay, label from merged"""))
def j10(spark, sf):
    r = _ingest(spark, sf, merged_only=True)
    return r.select("tick", "trip_id", "id", "timestamp", "stop_id", "delay", "label")


def _ingest(spark, sf, merged_only=False):
    docs = rf.position_documents(spark, sf), rf.update_documents(spark, sf)
    trips, cal, hol = tv.realtime_trips(spark, sf), tv.calendar(spark, sf), holidays(spark)
    if merged_only:
        gp, gu, _, _ = ing.valid_rows(*docs)
        return ing.merged_rows(gp, gu, trips, cal, hol)
    return ing.ingest(*docs, trips, cal, hol)


LOC_OUT = ["id", "trip_id", "occupancy_status", "bearing", "latitude", "longitude", "speed", "timestamp",
           "start_epoch", "route_id", "direction_id", "is_deleted", "schedule_relationship", "stop_sequence", "stop_id",
           "stop_schedule_relationship", "departure_delay", "departure_time", "departure_uncertainty", "vehicle_id",
           "label", "license_plate", "delay"]


@register("C2_realtime_ingest", ev_sql("loc", f"select {', '.join(chr(34) + c + chr(34) for c in LOC_OUT)} from loc"))
def c2(spark, sf):
    return _present(_ingest(spark, sf).locations).select(*LOC_OUT)


# ------------------------------------------------------------------ service days
@register("X10_service_days", with_views("calendar", extra={"hol": _HOL_SQL}) + """
, d as (select distinct cast(ts as date) service_date from events),
dn as (select service_date, case when service_date in (select holiday from hol) then 'sunday'
       else lower(dayname(service_date)) end day_name from d),
cl as (unpivot calendar on monday, tuesday, wednesday, thursday, friday, saturday, sunday into name day_name value runs)
select cast(service_date as varchar) service_date, dn.day_name, service_id from dn join cl on cl.day_name = dn.day_name and runs = 1""")
def x10(spark, sf):
    from ..sources.tables import read_table
    dates = read_table(spark, sf, "events").select(F.to_date(F.col("ts").cast("timestamp")).alias("service_date"))
    out = sv.service_days(tv.calendar(spark, sf), dates, holidays(spark))
    return out.withColumn("service_date", F.col("service_date").cast("string"))


@register("J13_active_trips", with_views("trips", "calendar") + f"""
select t.* from trips t where service_id in (
  select service_id from calendar where sunday = 1)""")
def j13(spark, sf):
    dates = spark.range(1).select(F.lit(SUNDAY).cast("date").alias("service_date"))
    services = sv.service_days(tv.calendar(spark, sf), dates, holidays(spark))
    return sv.active_trips(tv.trips(spark, sf), services)


@register("X11_week_end", with_views("vehicle_locations") + """
select distinct cast(cast(make_timestamp("timestamp" * 1000000) as date) as varchar) week_start,
       cast(cast(make_timestamp("timestamp" * 1000000) as date) + 7 as varchar) week_end from vehicle_locations""")
def x11(spark, sf):
    d = tv.vehicle_locations(spark, sf).select(F.to_date(F.timestamp_seconds("timestamp")).alias("week_start")).distinct()
    return d.select(F.col("week_start").cast("string").alias("week_start"),
                    week_end("week_start").cast("string").alias("week_end"))
