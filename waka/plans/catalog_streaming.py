"""Registered queries: streaming (T1, T2, T4). Each starts an ``availableNow``
stream over a landing folder derived from the base tables, waits for it, and returns
what the sink holds; the oracle is the batch result over the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from ..oracle import with_views
from ..session import materialize, scratch_path
from ..sources import transit_views as tv
from ..streaming import ingest_stream as ist
from ..streaming.lag_state import END_TRIP, output_schema, stream_lags
from . import catalog_features as cf
from . import catalog_realtime as cr
from .registry import register, round_doubles


CHUNKS = 6     # files in which a feed of snapshots is replayed


@register("T1_T3_stream_ingest", cr.ev_sql("loc", f"select {', '.join(chr(34) + c + chr(34) for c in cr.LOC_OUT)} from loc"))
def t1(spark, sf):
    landing = ist.land_tick_bundles(spark, sf, scratch_path(spark, "landing"))
    table, ckpt = scratch_path(spark, "vehicle_locations"), scratch_path(spark, "ckpt_ingest")
    q = ist.start_ingest(spark, landing, table, ckpt, tv.realtime_trips(spark, sf), tv.calendar(spark, sf),
                         cr.holidays(spark))
    q.awaitTermination()
    return cr._present(spark.read.parquet(table)).select(*cr.LOC_OUT)


@register("T2_stream_dedupe", with_views("vehicle_locations_raw") +
          'select distinct id, "timestamp" from vehicle_locations_raw')
def t2(spark, sf):
    raw = tv.vehicle_locations_raw(spark, sf).select("id", "timestamp", "trip_id", "event_id")
    landing = scratch_path(spark, "raw_locations")
    raw.withColumn("day", F.to_date(F.timestamp_seconds("timestamp"))).write.partitionBy("day").parquet(landing)
    out, ckpt = scratch_path(spark, "dedup"), scratch_path(spark, "ckpt_dedup")
    schema = spark.read.parquet(landing).schema
    q = ist.dedupe_stream(spark, landing, schema, out, ckpt)
    q.awaitTermination()
    return spark.read.parquet(out).select("id", "timestamp")


def land_in_order(df, chunk, path: str, **marker) -> None:
    """Landing fixture: one file for each value of ``chunk`` (a few), the files in its order, as a feed would land them; then a
    file with one row of nulls but for ``marker``."""
    spark = df.sparkSession
    staged = scratch_path(spark, "landing_chunks")
    df.withColumn("_chunk", chunk).write.parquet(staged)
    rows = spark.read.parquet(staged)
    for (c,) in sorted(rows.select("_chunk").distinct().collect()):
        rows.where(F.col("_chunk") == c).drop("_chunk").coalesce(1).write.mode("append").parquet(path)
    end = spark.range(1).select(*[F.lit(marker.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema])
    end.coalesce(1).write.mode("append").parquet(path)


@register("T4_stream_lag_features", cf._w(["matched", "l"], "select * from l"))
def t4(spark, sf):
    """A week replayed in half-day files, in which rows land up to an hour late; the watermark's delay is two hours."""
    m = cf.matched(spark, sf)
    landing = scratch_path(spark, "matched_half_days")
    lands_at = F.col("timestamp") + F.pmod(F.xxhash64("id", "timestamp"), F.lit(3600))
    land_in_order(m, F.floor(lands_at / 43200), landing, trip_id=END_TRIP, timestamp=cf.HI + 10 * 86400)
    s = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 3).parquet(landing)
    out, ckpt = scratch_path(spark, "lags"), scratch_path(spark, "ckpt_lags")
    q = (stream_lags(s).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    lf = spark.read.schema(output_schema()).parquet(out)
    return round_doubles(lf, only={c for c in lf.columns if c.endswith("_avg")}).select(
        "id", "timestamp", *fe.lag_column_names())


@register("T3_stream_stream_merge", cr.ev_sql("merged", """
select tick, trip_id, id, "timestamp", stop_id, delay, label from merged
where vehicle_id is not null and label is not null"""))
def t3(spark, sf):
    """Both feeds replayed in the order of their snapshots; the watermark's delay is ten minutes, so the state of a snapshot
    is dropped as the feeds go on."""
    from ..sources import realtime_feed as rf
    from ..streaming.merge_stream import end_marker_documents, merge_streams, start_merge
    folders = {}
    for name, docs in (("positions", rf.position_documents(spark, sf)), ("updates", rf.update_documents(spark, sf))):
        folders[name] = scratch_path(spark, f"{name}_landing")
        stamped = materialize(docs.select("value", F.get_json_object("value", "$.response.header.timestamp").cast("long").alias("at")), name)
        lo, hi = stamped.agg(F.min("at"), F.max("at")).first()
        chunk = F.floor((F.col("at") - lo) * CHUNKS / (hi - lo + 1))
        for c in range(CHUNKS):
            stamped.where(chunk == c).select("value").coalesce(1).write.mode("append").text(folders[name])
    for name, doc in zip(folders, end_marker_documents(int(hi)), strict=True):
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("append").text(folders[name])
    out, ckpt = scratch_path(spark, "merged_stream"), scratch_path(spark, "ckpt_merge")
    m = merge_streams(spark, folders["positions"], folders["updates"], tv.realtime_trips(spark, sf), tv.calendar(spark, sf),
                      cr.holidays(spark), files_per_trigger=1)
    start_merge(m, out, ckpt).awaitTermination()
    return spark.read.schema(m.schema).parquet(out).select("tick", "trip_id", "id", "timestamp", "stop_id", "delay", "label")
