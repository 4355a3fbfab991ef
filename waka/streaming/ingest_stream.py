"""Structured Streaming ingest.

T1  the feed fetcher lands bundle files, each holding both feeds of one or more snapshots (ticks)
    (``positions\\t{doc}`` and ``updates\\t{doc}`` lines); a file-source stream
    hands whole files to ``foreachBatch``, which runs the batch ingest (C2) on the
    micro-batch and appends only new (id, timestamp) keys to the table (K1), so a
    replayed batch after a failure writes nothing twice.
T2  the first row of each key across ticks: ``foreachBatch`` against the stored keys.
T3  here the two feeds of a tick are joined inside the micro-batch (the bundle of a snapshot is
    in one file, never split across micro-batches); ``merge_stream`` joins two separate
    feed streams instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import append_new_rows
from ..plans.ingest import ingest
from ..sources.realtime_feed import position_documents, update_documents

TAB = "\t"


def land_tick_bundles(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Fixture landing zone: text files with both feed documents of some ticks; a tick is never split over files."""
    pos = position_documents(spark, sf_dir).select("tick_no", F.concat(F.lit("positions" + TAB), "value").alias("value"))
    upd = update_documents(spark, sf_dir).select("tick_no", F.concat(F.lit("updates" + TAB), "value").alias("value"))
    both = pos.unionByName(upd)
    both.repartition("tick_no").select("value").write.mode("overwrite").text(root)
    return root


def split_bundle(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    parts = F.split(F.col("value"), TAB, 2)
    tagged = batch.select(parts[0].alias("feed"), parts[1].alias("value"))
    return (tagged.where(F.col("feed") == "positions").select("value"),
            tagged.where(F.col("feed") == "updates").select("value"))


def start_ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str, trips: DataFrame,
                 calendar: DataFrame, holidays: DataFrame | None, files_per_trigger: int = 50,
                 available_now: bool = True):
    """Start the ingest stream; returns the StreamingQuery."""
    stream = (spark.readStream.format("text").option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", files_per_trigger).load(landing))

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        pos_docs, upd_docs = split_bundle(batch)
        res = ingest(pos_docs, upd_docs, trips, calendar, holidays)
        rows = res.locations.withColumn("obs_date", F.to_date(F.timestamp_seconds("timestamp")))
        append_new_rows(batch.sparkSession, table_path, rows, ["obs_date", "id", "timestamp"],
                        partition_by=["obs_date"])

    w = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


#: Where a row was landed: file by file as they came, then by place.
ARRIVAL = ["_arrived", "_file", "_row"]


def dedupe_stream(spark: SparkSession, landing: str, schema: str, out_path: str, checkpoint: str,
                  files_per_trigger: int = 50):
    """Keep the first row of each (id, timestamp) key in the order of arrival.

    Files are taken in the order in which they landed, so within a micro-batch the first row is that of the oldest file (ties: of
    the smallest path, then the first place in it). The table itself is the state: each micro-batch is anti-joined with the
    stored keys of the dates it touches, so nothing is too late and no key is ever forgotten. Nulls count as key values."""
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
         .select("*", F.col("_metadata.file_modification_time").alias("_arrived"), F.col("_metadata.file_path").alias("_file"),
                 F.col("_metadata.row_index").alias("_row")))

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("obs_date", F.to_date(F.timestamp_seconds("timestamp")))
        append_new_rows(batch.sparkSession, out_path, rows, ["obs_date", "id", "timestamp"], partition_by=["obs_date"], order=ARRIVAL)

    return (s.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
