"""Stored layout of the locations: what the reads of S6, P6, J7 and K1 prune by.

The table is partitioned by observation date and bucketed by (trip_id, stop_id), each file sorted by
trip and time. A time range becomes partition filters beside the pushed row filter, so only the
dates it touches are opened; the join with the segments of a trip (J7) finds the
locations already dealt by its keys, so the big side isn't shuffled, and a hot trip is
spread over its stops.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BUCKETS = 16
JOIN_KEYS = ["trip_id", "stop_id"]


def store_locations(locations: DataFrame, path: str | None = None, buckets: int = BUCKETS) -> str:
    """Write ``locations`` in the layout; returns the table's name in the session's catalog."""
    spark = locations.sparkSession
    name = f"locations_{uuid.uuid4().hex[:12]}"
    day = F.to_date(F.timestamp_seconds("timestamp"))
    # dealt by date and bucket: one file for each bucket of a date
    dealt = locations.withColumn("obs_date", day).repartition("obs_date", F.pmod(F.hash(*JOIN_KEYS), F.lit(buckets)))
    (dealt.write.partitionBy("obs_date").bucketBy(buckets, *JOIN_KEYS).sortBy(*JOIN_KEYS, "timestamp")
     .option("path", path or scratch_path(spark, "locations")).saveAsTable(name))
    return name


def in_range(lo: int, hi: int) -> Column:
    """Rows with lo <= timestamp < hi (epoch seconds), as a filter of partitions and of rows."""
    first, last = (dt.datetime.fromtimestamp(t, dt.timezone.utc).date() for t in (lo, hi - 1))
    return (F.col("obs_date").between(F.lit(first), F.lit(last)) & (F.col("timestamp") >= lo) & (F.col("timestamp") < hi))


def read_range(spark: SparkSession, name: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """The stored locations, those of a time range if one is given."""
    rows = spark.table(name)
    return (rows if lo is None else rows.where(in_range(lo, hi))).drop("obs_date")
