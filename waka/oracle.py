"""DuckDB definitions of the transit views, used by the SQL oracles.

The driver pre-registers only the base tables, so each oracle query starts with
``with_views(...)``: the CTEs it needs, in dependency order.
"""

from __future__ import annotations

VIEW_SQL = {
    "stops": """
select concat('S', s_suppkey) stop_id, cast(s_nationkey % 2 as int) location_type,
       cast(s_suppkey as varchar) stop_code,
       -36.9e0 + (s_suppkey % 100) / 1000e0 stop_lat, 174.7e0 + (s_suppkey % 70) / 1000e0 stop_lon,
       s_name stop_name
from supplier""",
    "stop_times": """
select cast(l_orderkey as varchar) trip_id, concat('S', l_suppkey) stop_id,
       cast(row_number() over (partition by l_orderkey
            order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as int) stop_sequence
from lineitem""",
    "trips": """
select cast(o_orderkey as varchar) trip_id, concat('R', o_custkey % 10) route_id,
       concat('SV', o_custkey % 25) service_id, cast(o_orderkey % 2 as int) direction_id,
       concat('SH', o_custkey % 10) shape_id
from orders""",
    "calendar": """
select concat('SV', n_nationkey) service_id,
       cast(n_nationkey % 2 as int) monday, cast(n_nationkey % 2 as int) tuesday,
       cast(n_nationkey % 2 as int) wednesday, cast(n_nationkey % 2 as int) thursday,
       cast(n_nationkey % 3 % 2 as int) friday, cast(1 - n_nationkey % 2 as int) saturday,
       cast(case when n_nationkey % 5 = 0 then 1 else 0 end as int) sunday
from nation""",
    "shapes": """
select shape_id, stop_lat shape_pt_lat, stop_lon shape_pt_lon, k shape_pt_sequence from (
  select concat('SH', n_nationkey) shape_id, -36.9e0 + (s_suppkey % 100) / 1000e0 stop_lat,
         174.7e0 + (s_suppkey % 70) / 1000e0 stop_lon, s_suppkey * 2 + r_regionkey k
  from supplier, nation, region
  where n_nationkey < 10 and r_regionkey < 2 and (s_suppkey + n_nationkey) % 11 <> 0) q""",
    "vehicle_locations_raw": """
select event_id, user_id id, cast(floor(epoch(ts)) as bigint) as "timestamp", event_type trip_id,
       concat('S', user_id % 10) stop_id, cast(user_id % 10 as int) stop_sequence,
       cast(user_id % 2 as int) direction_id,
       case when k % 5 = 0 then null else cast((user_id * 37) % 360 as double) end bearing,
       value speed, cast(floor(value) as int) - 20 delay,
       case when k % 3 = 0 then null else cast(k % 6 as int) end occupancy_status,
       case when k % 2 = 0 then null else cast(k as int) end departure_delay,
       cast(0 as int) departure_uncertainty,
       -36.9e0 + (event_id % 97) / 970e0 latitude, 174.7e0 + (event_id % 89) / 890e0 longitude, ts
from (select *, cast(json_extract_string(props, '$.k') as int) k from events) e""",
    "vehicle_locations": """
select * exclude (rn) from (
  select *, row_number() over (partition by id, "timestamp" order by event_id) rn
  from vehicle_locations_raw) q where rn = 1""",
    "segments": """
select concat(k, '-', k + 1) segment_id, concat('S', k) start_stop_id, concat('S', k + 1) end_stop_id
from (select cast(n_nationkey as int) k from nation where n_nationkey < 9) q""",
    "trip_segments": """
select distinct event_type trip_id, segment_id from events, segments""",
}

DEPS = {
    "vehicle_locations": ["vehicle_locations_raw"],
    "trip_segments": ["segments"],
}


def _closure(names):
    out = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in out:
            out.append(n)

    for n in names:
        add(n)
    return out


def with_views(*names: str, extra: dict | None = None) -> str:
    """``WITH`` clause defining the named views (plus ``extra`` name -> sql, in order)."""
    parts = [f"{n} AS MATERIALIZED ({VIEW_SQL[n]})" for n in _closure(names)]
    for n, sql in (extra or {}).items():
        parts.append(f"{n} AS MATERIALIZED ({sql})")
    return "WITH " + ",\n".join(parts) + "\n"
