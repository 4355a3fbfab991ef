"""Streams whose state ends: late and split trip-days, and the first row of each key."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from waka.operators import features as fe
from waka.plans import catalog_features as cf
from waka.plans.catalog_streaming import land_in_order
from waka.session import scratch_path
from waka.streaming.ingest_stream import dedupe_stream
from waka.streaming.lag_state import END_TRIP, output_schema, stream_lags

SF = "/root/testdata/sf0.001"


def replay(spark, rows, chunk, files=1, delay="2 hours"):
    landing, out, ckpt = (scratch_path(spark, n) for n in ("state_landing", "state_out", "state_ckpt"))
    land_in_order(rows, chunk, landing, trip_id=END_TRIP, timestamp=cf.HI + 10 * 86400)
    s = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(landing)
    q = (stream_lags(s, delay=delay).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(output_schema()).parquet(out), q


def sorted_rows(df):
    cols = ["id", "timestamp", *fe.lag_column_names()]
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_late_and_split_trip_days_equal_the_batch(spark):
    """Rows land up to an hour late in quarter-day files, so a trip-day comes in several and out of order. Nothing is left in the state."""
    m = cf.matched(spark, SF)
    lands = F.col("timestamp") + F.pmod(F.xxhash64("id"), F.lit(3600))
    got, q = replay(spark, m, F.floor(lands / 21600), files=4)
    assert sorted_rows(got) == sorted_rows(fe.lag_features(m))
    states = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in states) > 0 and states[-1]["numRowsTotal"] == 0
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0


def test_rows_behind_the_watermark_are_dropped_and_counted(spark):
    m = cf.matched(spark, SF)
    late = F.pmod(F.xxhash64("id", "timestamp"), F.lit(10)) == 0        # one in ten lands three days late
    lands = F.col("timestamp") + F.when(late, 3 * 86400).otherwise(0)
    got, q = replay(spark, m, F.floor(lands / 86400))
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"])
    assert dropped > 0 and got.count() == m.count() - dropped
    assert [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1] == 0


def test_first_row_in_order_of_arrival_and_null_keys(spark):
    """Each file repeats keys of those before with other values, and a null key; a second run over the same files stores nothing."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("timestamp", T.LongType()), T.StructField("v", T.StringType())])
    landing, out = scratch_path(spark, "first_landing"), scratch_path(spark, "first_out")
    rng, want = random.Random(3), {}
    for k in range(5):
        rows = [(rng.randrange(30), 1_700_000_000 + 86400 * rng.randrange(3), f"{k}-{i}") for i in range(25)] + [(None, None, f"{k}-null"), (None, 5, f"{k}-five")]
        for i, t, v in rows:
            want.setdefault((i, t), v)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    for k in range(2):
        dedupe_stream(spark, landing, schema, out, scratch_path(spark, f"first_ckpt{k}"), files_per_trigger=2 + k).awaitTermination()
        got = {(r["id"], r["timestamp"]): r["v"] for r in spark.read.parquet(out).collect()}
        assert got == want and spark.read.parquet(out).count() == len(want)


def test_documents_over_several_lines(spark, tmp_path):
    """Pretty-printed snapshots, a file each: the stream merge and the batch parse read them whole."""
    from waka.operators.quality import with_errors
    from waka.plans import catalog_realtime as cr
    from waka.sources import realtime_feed as rf
    from waka.sources import transit_views as tv
    from waka.streaming.merge_stream import end_marker_documents, merge_streams, start_merge

    folders = {"positions": rf.position_documents, "updates": rf.update_documents}
    last = 0
    for name, docs in folders.items():
        (tmp_path / name).mkdir()
        for r in docs(spark, SF).collect():
            doc = json.loads(r["value"])
            last = max(last, doc["response"]["header"]["timestamp"])
            (tmp_path / name / f"{r['tick_no']}.json").write_text(json.dumps(doc, indent=1))
    for name, doc in zip(folders, end_marker_documents(last), strict=True):
        (tmp_path / name / "end.json").write_text(json.dumps(json.loads(doc), indent=1))
    parsed, rules = rf.parse_positions(rf.read_documents(spark, str(tmp_path / "positions"), multiline=True))
    lines, same_rules = rf.parse_positions(rf.position_documents(spark, SF))
    good = lambda rows, r: sorted((x["id"], x["timestamp"]) for x in with_errors(rows, r).where(F.size("errors") == 0).select("id", "timestamp").collect())
    have = good(parsed, rules)
    assert [x for x in have if x[0] != 0] == [x for x in good(lines, same_rules) if x[0] != 0] and have
    m = merge_streams(spark, str(tmp_path / "positions"), str(tmp_path / "updates"), tv.realtime_trips(spark, SF), tv.calendar(spark, SF),
                      cr.holidays(spark), files_per_trigger=500, multiline=True)      # one micro-batch: nothing is late
    start_merge(m, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    import __spark_entry__ as entry
    want = entry.queries()["T3_stream_stream_merge"](spark, SF)
    got = spark.read.schema(m.schema).parquet(str(tmp_path / "out")).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
