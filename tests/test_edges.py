"""Hand-made edge cases (FIXTURES section 3) on small literal frames."""

import json

import pytest
from pyspark.sql import functions as F

from waka.functions.dates import local_start
from waka.operators import network as nw
from waka.operators import quality as qa
from waka.operators import realtime as rt
from waka.operators import tables as tb
from waka.sources.realtime_feed import parse_positions, parse_updates


def _stops(spark, rows):
    return spark.createDataFrame(rows, "route_id string, trip_id string, service_id string, direction_id int, "
                                       "shape_id string, stop_id string, stop_code string, stop_lat double, "
                                       "stop_lon double, stop_sequence int")


def test_loop_trip_passes_division_fails_occurrence(spark):
    # first stop is also the last stop, and it is one of the journey's stops
    rows = [("R", "T", "S", 0, "SH", f"s{c}", str(c), 0.0, float(i), i) for i, c in enumerate([1, 2, 3, 1])]
    trip_stops = _stops(spark, rows)
    j = nw.journeys_df(spark, [["1", "3"]])
    cand = nw.candidate_trips(trip_stops.select("trip_id", "stop_code"), j)
    assert [r.trip_id for r in cand.collect()] == ["T"]
    assert nw.occurrence_match(trip_stops, j).count() == 0   # stop 1 counted twice: 3 != 2


def test_null_stop_code_makes_null_segment(spark):
    rows = [("R", "T", "S", 0, "SH", "a", "1", 0.0, 0.0, 1), ("R", "T", "S", 0, "SH", "b", None, 0.0, 1.0, 2),
            ("R", "T", "S", 0, "SH", "c", "3", 0.0, 2.0, 3)]
    segs = nw.key_segments(_stops(spark, rows)).collect()
    ids = sorted([s.segment_id for s in segs], key=str)
    assert None in ids and "1-None" not in ids


def test_off_shape_stop_absent_from_key_stops(spark):
    trips = spark.createDataFrame([("T", "R", "S", 0, "SH")], "trip_id string, route_id string, service_id string, "
                                                            "direction_id int, shape_id string")
    codes = spark.createDataFrame([("T", "a", 1, "1"), ("T", "b", 2, "2")],
                                  "trip_id string, stop_id string, stop_sequence int, stop_code string")
    stops = spark.createDataFrame([("a", "1", 1.5, 2.5), ("b", "2", 9.0, 9.0)],
                                  "stop_id string, stop_code string, stop_lat double, stop_lon double")
    shapes = spark.createDataFrame([("SH", 1.5, 2.5), ("SH", 1.5, 2.5)], "shape_id string, shape_pt_lat double, shape_pt_lon double")
    on = nw.on_shape_stops(trips, codes, stops, shapes).collect()
    assert [r.stop_id for r in on] == ["a"]          # no fan-out on the repeated shape point


def _doc(entities, ts=1700000000):
    return json.dumps({"response": {"header": {"timestamp": ts}, "entity": entities}})


TRIP = {"trip_id": "T1", "start_time": "22:15:00", "start_date": "20260203", "route_id": "R", "direction_id": 0}


def _pos(**over):
    e = {"id": "50731", "vehicle": {"trip": dict(TRIP), "position": {"latitude": -36.8, "longitude": 174.7,
                                                                     "bearing": "270", "speed": 0},
                                    "timestamp": 1769900011, "vehicle": {"id": "50731", "label": "NB"}}}
    e.update(over)
    return e


def test_string_numbers_and_start_time(spark):
    docs = spark.createDataFrame([(_doc([_pos()]),)], "value string")
    df, rules = parse_positions(docs)
    good, bad = rt.validate(df, rules)
    r = good.collect()[0]
    assert r.id == 50731 and r.bearing == 270.0 and bad.count() == 0
    # 2026-02-03 22:15 in the feed zone (UTC+13 in summer) is 09:15 UTC
    assert good.select(F.unix_seconds("start_time")).first()[0] == 1770110100


def test_bad_start_time_is_rejected(spark):
    e = _pos()
    e["vehicle"]["trip"]["start_time"] = "25:10:00"
    df, rules = parse_positions(spark.createDataFrame([(_doc([e]),)], "value string"))
    good, bad = rt.validate(df, rules)
    assert good.count() == 0 and bad.first().errors == ["start_time"]


def test_missing_trip_is_skipped(spark):
    e = _pos()
    del e["vehicle"]["trip"]
    df, _ = parse_positions(spark.createDataFrame([(_doc([e]),)], "value string"))
    assert df.count() == 0


def test_later_invalid_entity_does_not_overwrite(spark):
    good_e, bad_e = _pos(), _pos()
    bad_e["vehicle"]["position"]["latitude"] = "north"
    df, rules = parse_positions(spark.createDataFrame([(_doc([good_e, bad_e]),)], "value string"))
    good, _ = rt.validate(df, rules)
    last = rt.last_per_trip(good.select("tick", "pos", *rt.POSITION_COLUMNS)).collect()
    assert len(last) == 1 and last[0].pos == 0


def _upd(stu, label="NB", deleted=None):
    tu = {"trip": dict(TRIP), "stop_time_update": stu, "vehicle": {"id": "50731"}, "timestamp": 1769900011, "delay": "12"}
    if label is not None:
        tu["vehicle"]["label"] = label
    e = {"id": "x", "trip_update": tu}
    if deleted is not None:
        e["is_deleted"] = deleted
    return e


def test_stop_time_update_shapes(spark):
    one = {"stop_sequence": 4, "stop_id": "S4", "departure": {"delay": 30}}
    other = {"stop_sequence": 9, "stop_id": "S9"}
    ents = [_upd([one, other]), _upd(one), _upd([])]
    df, rules = parse_updates(spark.createDataFrame([(_doc(ents),)], "value string"))
    marked = qa.with_errors(df, rules).orderBy("pos").collect()
    assert marked[0].stop_sequence == 4 and marked[0].departure_delay == 30 and marked[0].errors == []
    assert marked[1].stop_id == "S4" and marked[1].delay == 12 and marked[1].is_deleted is False
    assert "stop_sequence" in marked[2].errors


def test_update_without_label_rejected_after_merge(spark):
    pos_docs = spark.createDataFrame([(_doc([_pos()]),)], "value string")
    upd_docs = spark.createDataFrame([(_doc([_upd({"stop_sequence": 1, "stop_id": "S1"}, label=None)]),)], "value string")
    p, pr_ = parse_positions(pos_docs)
    u, ur_ = parse_updates(upd_docs)
    gp, _ = rt.validate(p, pr_)
    gu, _ = rt.validate(u, ur_)
    merged = rt.merge_feeds(rt.last_per_trip(gp.select("tick", "pos", *rt.POSITION_COLUMNS)),
                            rt.last_per_trip(gu.select("tick", "pos", "trip_id", *rt.UPDATE_COLUMNS)))
    good, bad = qa.split_valid(merged, rt.merged_rules())
    assert good.count() == 0 and bad.first().errors == ["label"]


def test_ambiguous_hour_takes_standard_time(spark):
    df = spark.createDataFrame([("20260405", "2:30:00"), ("20260927", "2:30:00"), ("20260405", "24:00:00")],
                               "d string, t string")
    out = df.select(F.date_format(F.to_utc_timestamp(local_start("d", "t"), "UTC"), "yyyy-MM-dd HH:mm").alias("u")).collect()
    assert out[0].u == "2026-04-04 14:30"
    assert out[2].u is None


def test_first_write_wins_and_replay(spark):
    batch = spark.createDataFrame([(1, 10, 0, 0, "first"), (1, 10, 0, 1, "second")],
                                  "id long, timestamp long, tick long, pos int, v string")
    kept = rt.first_wins(batch).collect()
    assert [r.v for r in kept] == ["first"]
    existing = spark.createDataFrame([(1, 10)], "id long, timestamp long")
    assert rt.insert_ignore(existing, batch).count() == 0


def test_training_set_duplicate_aborts(spark):
    df = spark.createDataFrame([(1, 10), (1, 10)], "id long, timestamp long")
    with pytest.raises(ValueError):
        qa.assert_unique(df, ["id", "timestamp"], "training_set")


def test_upsert_all_key_table_ignores_and_keeps_absent(spark):
    old = spark.createDataFrame([("t", "s1"), ("t", "s2")], "trip_id string, segment_id string")
    new = spark.createDataFrame([("t", "s1"), ("u", "s3")], "trip_id string, segment_id string")
    assert sorted(tuple(r) for r in tb.upsert(old, new, ["trip_id", "segment_id"]).collect()) == \
        [("t", "s1"), ("t", "s2"), ("u", "s3")]
    o2 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    n2 = spark.createDataFrame([("a", 9)], "k string, v int")
    assert sorted(tuple(r) for r in tb.upsert(o2, n2, ["k"]).collect()) == [("a", 9), ("b", 2)]


def test_delete_cascade_and_restrict(spark):
    trips = spark.createDataFrame([("a",), ("b",)], "trip_id string")
    locs = spark.createDataFrame([("b",)], "trip_id string")
    segs = spark.createDataFrame([("a", "s"), ("b", "s")], "trip_id string, segment_id string")
    remaining, report = tb.delete_rows(trips, trips, "trip_id", restrict=[locs])
    assert sorted(r.trip_id for r in remaining.collect()) == ["b"]
    assert sorted((r.trip_id, r.deleted) for r in report.collect()) == [("a", True), ("b", False)]
    assert [r.trip_id for r in tb.cascade(segs, report, "trip_id").collect()] == ["b"]


def test_null_rate_threshold_is_strict(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (3,)], "x int")
    assert qa.high_null_columns(df, 0.40).count() == 0


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("d", 4)], "k string, v int")
    once = sorted(tuple(r) for r in tb.upsert(old, new, ["k"]).collect())
    twice = sorted(tuple(r) for r in tb.upsert(tb.upsert(old, new, ["k"]), new, ["k"]).collect())
    assert once == twice == [("a", 9), ("b", 2), ("c", 3), ("d", 4)]


def test_broken_documents_are_quarantined(spark):
    """No JSON, no entity list: one rejected row each; an empty list has nothing to reject."""
    docs = spark.createDataFrame([("{broken",), ('{"response": {}}',), ('{"response": {"header": {"timestamp": 1}, "entity": []}}',),
                                  (_doc([_pos()]),)], "value string")
    for parse, n_good in ((parse_positions, 1), (parse_updates, 0)):
        good, bad = rt.validate(*parse(docs))
        assert good.count() == n_good
        assert [("document" in r.errors) for r in bad.collect()] == [True, True]


def test_stream_dedupe_keeps_every_key_in_any_file_order(spark, tmp_path):
    """Keys of a month, written by four tasks in random order, each twice."""
    from waka.streaming.ingest_stream import dedupe_stream

    rows = spark.range(3000).select((F.col("id") % 50).alias("id"), (F.lit(1_770_000_000) + F.col("id") * 900).alias("timestamp"))
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    rows.union(rows).orderBy(F.rand(3)).repartition(4).write.parquet(landing)
    dedupe_stream(spark, landing, rows.schema, out, str(tmp_path / "ckpt"), files_per_trigger=1).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 3000 == got.select("id", "timestamp").distinct().count()
