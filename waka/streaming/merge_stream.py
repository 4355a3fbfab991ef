"""The two realtime feeds joined stream-to-stream.

Each feed is its own file stream. Per feed: parse -> validate -> keep active trips
(stream-static joins only) -> last valid entity per (tick, trip) as a watermarked
aggregation, so each side holds one row per key; the two aggregated streams are then
inner-joined on (tick time, trip_id). Both operators keep state only until the
watermark passes the tick, and the join sees at most one row per key on each side.

A bounded replay ends with an end-of-stream marker: one valid entity of a trip that
is never active, placed after the last tick by more than the watermark delay. It moves the watermark past every real
tick (so their state is emitted) and is itself dropped by the active-trip join.
Snapshots older than the watermark (the youngest seen, less the delay) count as late.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import FEED_TZ, weekday_name
from ..operators import realtime as rt
from ..operators.quality import with_errors
from ..operators.service import calendar_long
from ..plans.ingest import tick_service_date
from ..sources.realtime_feed import document_stream, parse_positions, parse_updates

END_TRIP = "__end_of_stream__"


def active_stream(rows: DataFrame, trips: DataFrame, calendar: DataFrame, holidays: DataFrame | None,
                  tz: str = FEED_TZ) -> DataFrame:
    """J13 for streaming rows: the service day of the row's tick, then two stream-static
    joins (trip -> service, (service, day) -> runs)."""
    r = rows.withColumn("service_date", tick_service_date("tick", tz))
    if holidays is not None:
        h = holidays.select(F.col("holiday").cast("date").alias("service_date"), F.lit(True).alias("_hol")).distinct()
        r = r.join(h, "service_date", "left")
        day = F.when(F.col("_hol"), F.lit("sunday")).otherwise(weekday_name("service_date"))
    else:
        day = weekday_name("service_date")
    r = r.withColumn("day_name", day)
    runs = calendar_long(calendar).where(F.col("runs") == 1).select("service_id", "day_name")
    out = r.join(trips.select("trip_id", "service_id"), "trip_id").join(runs, ["service_id", "day_name"], "left_semi")
    return out.drop("service_date", "day_name", "service_id", "_hol")


def _side(spark: SparkSession, landing: str, parse, cols, trips, calendar, holidays, delay: str,
          files_per_trigger: int, multiline: bool) -> DataFrame:
    df, rules = parse(document_stream(spark, landing, files_per_trigger, multiline))
    row = F.struct("tick", "pos", *[c for c in cols if c not in ("tick", "pos")], "errors")
    # the rows leave through a generator, below which no filter on ``errors`` is pushed: it would compute every field many times
    df = with_errors(df, rules).select(F.inline(F.array(row)))
    df = df.withColumn("tick_ts", F.timestamp_seconds("tick")).withWatermark("tick_ts", delay)
    ok = df.where(F.size("errors") == 0).select("tick_ts", "tick", "pos", *cols)
    act = active_stream(ok, trips, calendar, holidays)
    other = [c for c in ["tick", "pos", *cols] if c != "trip_id"]
    last = act.groupBy("tick_ts", "trip_id").agg(F.max_by(F.struct(*other), F.col("pos")).alias("r"))
    return last.select("tick_ts", "trip_id", *[F.col(f"r.{c}").alias(c) for c in other])


def merge_streams(spark: SparkSession, positions_landing: str, updates_landing: str, trips: DataFrame,
                  calendar: DataFrame, holidays: DataFrame | None, delay: str = "10 minutes",
                  files_per_trigger: int = 50, multiline: bool = False) -> DataFrame:
    """Streaming DataFrame of merged locations (J10 on streams), append mode. ``multiline``: a file is one document, over as many lines as it has."""
    p = _side(spark, positions_landing, lambda d: parse_positions(d), rt.POSITION_COLUMNS, trips, calendar,
              holidays, delay, files_per_trigger, multiline)
    u = _side(spark, updates_landing, lambda d: parse_updates(d), ["trip_id", *rt.UPDATE_COLUMNS], trips,
              calendar, holidays, delay, files_per_trigger, multiline).drop("pos").withColumnRenamed("tick", "_utick")
    merged = p.join(u, ["tick_ts", "trip_id"]).drop("_utick")
    rules = rt.merged_rules()
    return merged.where(rules["vehicle_id"] & rules["label"])


def start_merge(merged: DataFrame, path: str, checkpoint: str):
    """Start the merge into parquet files at ``path``; returns the StreamingQuery. Every micro-batch plans the whole query anew, and
    the constraints that could be inferred from its dozens of field expressions grow combinatorially: the query runs without them."""
    spark, name = merged.sparkSession, "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")       # a query keeps the settings of its start
    try:
        return (merged.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(availableNow=True).start())
    finally:
        spark.conf.set(name, before)


def end_marker_documents(last_tick: int, after_seconds: int = 86400) -> tuple[str, str]:
    """One position and one update document carrying a single valid entity of a trip that
    is never active, ``after_seconds`` after ``last_tick`` (more than the watermark delay)."""
    tick = last_tick + after_seconds
    trip = {"trip_id": END_TRIP, "start_time": "0:00:00", "start_date": "20000101", "route_id": "-"}
    pos = {"id": "0", "vehicle": {"trip": trip, "position": {"latitude": 0, "longitude": 0, "speed": 0},
                                  "timestamp": tick, "vehicle": {"id": "0"}}}
    upd = {"id": "0", "trip_update": {"trip": trip, "stop_time_update": {"stop_sequence": 0, "stop_id": "-"},
                                      "vehicle": {"id": "0", "label": "-"}, "timestamp": tick, "delay": 0}}

    def doc(e):
        return json.dumps({"response": {"header": {"timestamp": tick}, "entity": [e]}})

    return doc(pos), doc(upd)
