"""Transit tables expressed over the driver's generic tables.

The transit feed (calendar, stops, stop_times, trips, shapes), the realtime table
(vehicle_locations) and the network tables (segments, trip_segments) are derived
from the TPC-H-like tables with plain projections, so every query's work grows with
the input. The same definitions exist as DuckDB CTEs in ``waka.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import read_table


def _lat(key: Column, mod: int, div: float) -> Column:
    return F.lit(-36.9) + (key % mod) / F.lit(div)


def _lon(key: Column, mod: int, div: float) -> Column:
    return F.lit(174.7) + (key % mod) / F.lit(div)


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("S"), k.cast("string")).alias("stop_id"),
        (F.col("s_nationkey") % 2).cast("int").alias("location_type"),
        k.cast("string").alias("stop_code"),
        _lat(k, 100, 1000.0).alias("stop_lat"),
        _lon(k, 70, 1000.0).alias("stop_lon"),
        F.col("s_name").alias("stop_name"),
    )


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem; stop_sequence numbers the lines of an order.

    The window is partitioned by order key: an order has a handful of lines, so the
    sort per group is small; the five order columns make the sequence deterministic.
    """
    li = read_table(spark, sf_dir, "lineitem").withColumn("trip_id", F.col("l_orderkey").cast("string"))
    # partitioned by the trip id itself, so later per-trip windows reuse this shuffle
    w = Window.partitionBy("trip_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return li.select(
        "trip_id",
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("stop_id"),
        F.row_number().over(w).cast("int").alias("stop_sequence"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.concat(F.lit("R"), (c % 10).cast("string")).alias("route_id"),
        F.concat(F.lit("SV"), (c % 25).cast("string")).alias("service_id"),
        (F.col("o_orderkey") % 2).cast("int").alias("direction_id"),
        F.concat(F.lit("SH"), (c % 10).cast("string")).alias("shape_id"),
    )


WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    odd = (k % 2).cast("int")
    return n.select(
        F.concat(F.lit("SV"), k.cast("string")).alias("service_id"),
        odd.alias("monday"),
        odd.alias("tuesday"),
        odd.alias("wednesday"),
        odd.alias("thursday"),
        (k % 3 % 2).cast("int").alias("friday"),
        (F.lit(1) - k % 2).cast("int").alias("saturday"),
        F.when(k % 5 == 0, 1).otherwise(0).cast("int").alias("sunday"),
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape points: every supplier location on ten shapes, each point twice.

    The fixture defines them as supplier x (nation < 10) x (region < 2). Both small
    sides are bounded by their predicates (at most 10 and 2 keys), so each becomes a
    scalar-subquery array exploded per supplier row: output linear in supplier, no join.
    """
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    nat = read_table(spark, sf_dir, "nation").where(F.col("n_nationkey") < 10)
    reg = read_table(spark, sf_dir, "region").where(F.col("r_regionkey") < 2)
    nat_keys = nat.select(F.collect_list("n_nationkey")).scalar()
    reg_keys = reg.select(F.collect_list("r_regionkey")).scalar()
    k = F.col("s_suppkey")
    return (
        s.select(k, F.explode(nat_keys).alias("n"))
        .where((k + F.col("n")) % 11 != 0)
        .select(k, "n", F.explode(reg_keys).alias("r"))
        .select(
            F.concat(F.lit("SH"), F.col("n").cast("string")).alias("shape_id"),
            _lat(k, 100, 1000.0).alias("shape_pt_lat"),
            _lon(k, 70, 1000.0).alias("shape_pt_lon"),
            (k * 2 + F.col("r")).alias("shape_pt_sequence"),
        )
    )


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a parquet timestamp (NTZ read as UTC wall time)."""
    return F.unix_seconds(ts.cast("timestamp"))


def vehicle_locations_raw(spark: SparkSession, sf_dir: str, since: int | None = None,
                          until: int | None = None) -> DataFrame:
    """One location per event. Optional [since, until) epoch bounds are applied to the
    raw ``ts`` column so the parquet scan prunes row groups."""
    e = read_table(spark, sf_dir, "events")
    if since is not None:
        e = e.where(F.col("ts") >= F.timestamp_seconds(F.lit(since)).cast("timestamp_ntz"))
    if until is not None:
        e = e.where(F.col("ts") < F.timestamp_seconds(F.lit(until)).cast("timestamp_ntz"))
    k = F.get_json_object("props", "$.k").cast("int")
    u = F.col("user_id")
    return e.select(
        F.col("event_id"),
        u.alias("id"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.col("event_type").alias("trip_id"),
        F.concat(F.lit("S"), (u % 10).cast("string")).alias("stop_id"),
        (u % 10).cast("int").alias("stop_sequence"),
        (u % 2).cast("int").alias("direction_id"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(((u * 37) % 360).cast("double")).alias("bearing"),
        F.col("value").alias("speed"),
        (F.floor("value").cast("int") - 20).alias("delay"),
        F.when(k % 3 == 0, F.lit(None)).otherwise((k % 6).cast("int")).alias("occupancy_status"),
        F.when(k % 2 == 0, F.lit(None)).otherwise(k).alias("departure_delay"),
        F.lit(0).cast("int").alias("departure_uncertainty"),
        _lat(F.col("event_id"), 97, 970.0).alias("latitude"),
        _lon(F.col("event_id"), 89, 890.0).alias("longitude"),
        F.col("ts"),
    )


def vehicle_locations(spark: SparkSession, sf_dir: str, since: int | None = None,
                      until: int | None = None) -> DataFrame:
    """The stored table: primary key (id, timestamp), first write (lowest event_id) wins.

    ``min_by`` is a partial aggregate, so a hot key is combined map-side before the
    shuffle instead of being gathered into one task.
    """
    raw = vehicle_locations_raw(spark, sf_dir, since, until)
    cols = [c for c in raw.columns if c not in ("id", "timestamp")]
    return (
        raw.groupBy("id", "timestamp")
        .agg(F.min_by(F.struct(*cols), F.col("event_id")).alias("r"))
        .select("id", "timestamp", *[F.col(f"r.{c}").alias(c) for c in cols])
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation").where(F.col("n_nationkey") < 9)
    k = F.col("n_nationkey").cast("int")
    return n.select(
        F.concat(k.cast("string"), F.lit("-"), (k + 1).cast("string")).alias("segment_id"),
        F.concat(F.lit("S"), k.cast("string")).alias("start_stop_id"),
        F.concat(F.lit("S"), (k + 1).cast("string")).alias("end_stop_id"),
    )


def trip_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every realtime trip on every network segment (the fixture's definition).

    Trip ids are reduced first (partial aggregation), and the segment list (<= 9 rows,
    bounded by the ``nation < 9`` predicate) is attached as a scalar-subquery array:
    no join, no pairs beyond trips x 9.
    """
    seg = segments(spark, sf_dir)
    seg_arr = seg.select(F.collect_list("segment_id").alias("a")).scalar()
    trip_ids = read_table(spark, sf_dir, "events").select(F.col("event_type").alias("trip_id")).distinct()
    return trip_ids.select("trip_id", F.explode(seg_arr).alias("segment_id"))


VIEWS = {
    "stops": stops,
    "stop_times": stop_times,
    "trips": trips,
    "calendar": calendar,
    "shapes": shapes,
    "vehicle_locations": vehicle_locations,
    "segments": segments,
    "trip_segments": trip_segments,
}


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for name, fn in VIEWS.items():
        fn(spark, sf_dir).createOrReplaceTempView(name)


def realtime_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of the realtime feed (the event types), with a service from the calendar."""
    e = read_table(spark, sf_dir, "events").select(F.col("event_type").alias("trip_id")).distinct()
    n = F.length("trip_id")
    return e.select(
        "trip_id",
        F.concat(F.lit("R"), n.cast("string")).alias("route_id"),
        F.concat(F.lit("SV"), (n % 25).cast("string")).alias("service_id"),
        (n % 2).cast("int").alias("direction_id"),
        F.concat(F.lit("SH"), (n % 10).cast("string")).alias("shape_id"),
    )
