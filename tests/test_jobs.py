"""Jobs that end in stored tables: the weekly set with its gates, the refresh, versions, the stored layout."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from waka.operators import layout, network, profile, versions
from waka.operators import quality as qa
from waka.operators import tables as tb
from waka.plans import refresh_job as rj
from waka.plans import weekly
from waka.session import scratch_path
from waka.sources import transit_views as tv

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


# versions

def test_parts_that_stay_keep_their_folders(spark):
    root = scratch_path(spark, "versions")
    df = spark.range(30).selectExpr("id", "cast(id % 3 as string) k")
    first = versions.publish(spark, root, versions.current(spark, root), {
        "t": {"schema": df.select("id").schema.json(), "parts": versions.write_parts(df, "k", scratch_path(spark, "p"))}}, at=7)
    more = versions.write_parts(df.where("k = '1'").withColumn("id", F.col("id") + 100), "k", scratch_path(spark, "p"))
    second = versions.publish(spark, root, first, {"t": {"schema": df.select("id").schema.json(), "parts": more | {"2": None}}})
    assert (first["version"], second["version"], second["at"]) == (1, 2, 7)
    assert second["tables"]["t"]["parts"]["0"] == first["tables"]["t"]["parts"]["0"] and "2" not in second["tables"]["t"]["parts"]
    now = versions.read_parts(spark, versions.current(spark, root), "t")
    assert sorted(r.id for r in now.collect()) == sorted([*range(0, 30, 3), *range(101, 130, 3)])
    assert versions.read_parts(spark, first, "t").count() == 30       # readers of the version before still see it whole
    assert versions.read_parts(spark, second, "t", ["1"]).count() == 10
    with pytest.raises(RuntimeError):
        versions.publish(spark, root, first, {})       # another job has published version 2


# weekly job

def training(spark):
    from waka.plans import catalog_features as cf
    return cf.training(spark, SF)


def test_duplicate_leaves_the_table_untouched(spark):
    root, ts = scratch_path(spark, "weekly"), training(spark)
    report = weekly.upsert_week(spark, root, ts)
    assert (report.version, report.rows) == (1, ts.count())
    with pytest.raises(ValueError, match="duplicate"):
        weekly.upsert_week(spark, root, ts.unionByName(ts.limit(3)).withColumn("speed", F.lit(-1.0)))
    assert versions.current(spark, root)["version"] == 1
    assert rows(weekly.stored_training_set(spark, root)) == rows(ts)


def test_observed_nulls_are_those_of_the_report(spark):
    ts = training(spark)
    _, report = weekly.stage(ts, scratch_path(spark, "staged"))
    got = {c: n for c, n, _ in report.high_nulls(0.1)}
    want = {r["column_name"]: r["null_count"] for r in qa.high_null_columns(ts, 0.1).collect()}
    assert got == want and got


def test_week_replaces_values_and_keeps_the_rest(spark):
    root, ts = scratch_path(spark, "weekly"), training(spark)
    other = ts.withColumns({"timestamp": F.col("timestamp") + 366 * 86400, "obs_year": F.col("obs_year") + 1})
    weekly.upsert_week(spark, root, ts.unionByName(other))
    before = versions.current(spark, root)["tables"][weekly.TABLE]["parts"]
    again = ts.where(F.col("id") % 2 == 0).withColumn("speed", F.lit(-5.0))
    weekly.upsert_week(spark, root, again)
    after = versions.current(spark, root)["tables"][weekly.TABLE]["parts"]
    assert {k for k in after if after[k] != before[k]} == {k for k in after if k.startswith("2024w")} and len(after) > 1
    want = ts.withColumn("speed", F.when(F.col("id") % 2 == 0, F.lit(-5.0)).otherwise(F.col("speed"))).unionByName(other)
    assert rows(weekly.stored_training_set(spark, root)) == rows(want)


def test_weeks_together_are_weeks_apart(spark):
    """All weeks in one plan give what the weekly job gives for each."""
    loc, trips, segments = tv.vehicle_locations(spark, SF), tv.trip_segments(spark, SF), tv.segments(spark, SF)
    every = weekly.build_training_set(loc, trips, segments).toPandas()
    for monday in ("2024-01-08", "2024-01-15"):
        one = weekly.build_training_set(loc, trips, segments, monday).toPandas()
        lo = int(pd.Timestamp(monday).timestamp())
        same = every[(every["timestamp"] >= lo) & (every["timestamp"] < lo + 7 * 86400)]
        key = ["id", "timestamp", "segment_id"]
        pd.testing.assert_frame_equal(one.sort_values(key).reset_index(drop=True), same.sort_values(key).reset_index(drop=True), rtol=1e-12)


# refresh

def feed(spark, trips, stops=(("S1", "A"),)):
    t = spark.createDataFrame(trips, "trip_id string, route_id string")
    return {
        "calendar": spark.createDataFrame([("W", 1)], "service_id string, monday int"),
        "stops": spark.createDataFrame(list(stops), "stop_id string, stop_name string"),
        "trips": t, "segments": spark.createDataFrame([("1-2", "S1", "S2")], "segment_id string, start_stop_id string, end_stop_id string"),
        "trip_segments": t.select("trip_id", F.lit("1-2").alias("segment_id"))}


def test_refresh_keeps_absent_rows_and_rewrites_nothing_unchanged(spark):
    root = scratch_path(spark, "static")
    trips = [(f"T{i}", "R1") for i in range(40)]
    rj.publish_refresh(spark, root, feed(spark, trips), at=10)
    parts = lambda: versions.current(spark, root)["tables"]
    first = parts()
    same = {r["table_name"]: r for r in rj.publish_refresh(spark, root, feed(spark, trips), at=20).collect()}
    assert parts() == first and all(r["n_rewritten"] == 0 and r["n_new"] + r["n_changed"] + r["n_gone"] == 0 for r in same.values())
    assert {r["created_at"] for r in rj.read_refreshed(spark, root, "trips").collect()} == {20}
    third = [(t, "R2" if t == "T5" else r) for t, r in trips if t != "T7"] + [("T99", "R9")]
    report = {r["table_name"]: r for r in rj.publish_refresh(spark, root, feed(spark, third), at=30).collect()}
    assert [report["trips"][f"n_{k}"] for k in ("new", "changed", "gone", "same")] == [1, 1, 1, 38] and 1 <= report["trips"]["n_rewritten"] <= 3
    got = {r["trip_id"]: (r["route_id"], r["created_at"]) for r in rj.read_refreshed(spark, root, "trips").collect()}
    assert len(got) == 41 and got["T7"] == ("R1", 20) and got["T5"] == ("R2", 30) and got["T0"] == ("R1", 30) and got["T99"] == ("R9", 30)
    assert rj.read_refreshed(spark, root, "trip_segments").count() == 41 and rj.read_refreshed(spark, root, "trip_segments").columns == ["trip_id", "segment_id"]
    rj.publish_refresh(spark, root, feed(spark, trips), at=40)       # T7 is back, T99 is gone
    got = {r["trip_id"]: r["created_at"] for r in rj.read_refreshed(spark, root, "trips").collect()}
    assert len(got) == 41 and got["T7"] == 40 and got["T99"] == 30


def test_refresh_with_a_repeated_key_publishes_nothing(spark):
    root = scratch_path(spark, "static")
    rj.publish_refresh(spark, root, feed(spark, [("T1", "R1")]), at=10)
    with pytest.raises(ValueError, match="stops has 2 rows and 1 keys"):
        rj.publish_refresh(spark, root, feed(spark, [("T1", "R2")], stops=[("S1", "A"), ("S1", "B")]), at=20)
    assert versions.current(spark, root)["version"] == 1
    assert [r["route_id"] for r in rj.read_refreshed(spark, root, "trips").collect()] == ["R1"]


def test_upsert_refuses_repeated_new_keys(spark):
    old = spark.createDataFrame([(1, "a", 5)], "k int, v string, created_at int")
    new = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert rows(tb.upsert(old, new, ["k"], stamp=("created_at", 9))) == ["(1, 'b', 9)", "(2, 'c', 9)"]
    with pytest.raises(Exception, match="repeat a key"):
        tb.upsert(old, new.union(new), ["k"], stamp=("created_at", 9)).collect()


# layout

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_layout_prunes_and_joins_in_place(spark):
    loc = tv.vehicle_locations(spark, SF)
    name = layout.store_locations(loc, buckets=4)
    lo = 1704672000
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    week = layout.read_range(spark, name, lo, lo + 7 * 86400)
    assert rows(week.select(*loc.columns)) == rows(loc.where(F.col("timestamp").between(lo, lo + 7 * 86400 - 1)))
    text = plan(week)
    assert re.search(r"PartitionFilters: \[.*obs_date#\d+ >= 2024-01-08.*obs_date#\d+ <= 2024-01-14", text) and "GreaterThanOrEqual(timestamp" in text, text
    bridge = tv.trip_segments(spark, SF).join(tv.segments(spark, SF), "segment_id").select("trip_id", F.col("start_stop_id").alias("stop_id"), "segment_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = week.join(bridge.hint("merge"), ["trip_id", "stop_id"])
        text = plan(joined)
        big = text[:text.index("obs_date")].rsplit("SortMergeJoin", 1)[1]
        assert "Exchange" not in big and "Bucketed: true" in text
        assert joined.count() == loc.where(F.col("timestamp").between(lo, lo + 7 * 86400 - 1)).join(bridge, ["trip_id", "stop_id"]).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# journeys

def test_thousands_of_journeys(spark):
    rng = random.Random(4)
    trips = {f"t{i}": [f"{rng.randrange(60)}" for _ in range(rng.randint(2, 12))] for i in range(150)}
    journeys = [[str(rng.randrange(62)) for _ in range(rng.randint(1, 4))] for _ in range(10_000)]
    stops = spark.createDataFrame([(t, c) for t, codes in trips.items() for c in [*codes, None]], "trip_id string, stop_code string")
    frame = network.journeys_df(spark, journeys)
    got = {(r["trip_id"], r["journey_id"]) for r in network.trips_with_all(stops.distinct(), frame).collect()}
    assert got == {(t, j) for t, codes in trips.items() for j, want in enumerate(journeys) if set(want) <= set(codes)}
    got = {(r["trip_id"], r["journey_id"]) for r in network.occurrence_match(stops, frame).collect()}
    assert got == {(t, j) for t, codes in trips.items() for j, want in enumerate(journeys) if sum(c in want for c in codes) == len(want)}
    assert network.candidate_trips(stops, frame).count() == len({t for t, codes in trips.items() if any(set(w) <= set(codes) for w in journeys)})


# co-moments

def test_comoments_per_group_match_numpy(spark):
    rng = np.random.default_rng(2)
    n = 900
    pdf = pd.DataFrame({"week": rng.choice(["a", "b", None], n), "x": rng.normal(1e6, 1, n), "y": rng.normal(size=n), "z": 3.0})
    pdf["w"] = pdf["x"] * 2 + rng.normal(size=n) * 0.1
    pdf.loc[::7, "y"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("y", F.when(F.isnan("y"), None).otherwise(F.col("y"))).repartition(5)
    got = profile.corr_matrix(df, ["x", "y", "z", "w"], by=["week"]).toPandas()
    for week in ("a", "b", None):
        own = pdf[pdf["week"].isna() if week is None else pdf["week"] == week].dropna(subset=["x", "y", "z", "w"])
        m = got[got["week"].isna() if week is None else got["week"] == week].set_index(["col_a", "col_b"])["r"]
        for a, b in (("y", "x"), ("w", "x"), ("w", "y")):
            assert abs(m[a, b] - np.corrcoef(own[a], own[b])[0, 1]) < 1e-9
        assert m["z", "x"] is None or np.isnan(m["z", "x"])
    assert profile.corr_matrix(df.limit(0), ["x", "y"]).count() == 0


def test_profile_has_every_section(spark):
    import __spark_entry__ as entry

    got = {r["section"] for r in entry.queries()["C4_profile_table"](spark, SF).select("section").distinct().collect()}
    assert got == {"overview", "null_rates", "target_histograms", "feature_histograms", "average_histograms", "density", "percentiles", "value_counts",
                   "hour_counts", "delay_by_hour", "speed_by_hour", "delay_by_weekday", "delay_by_weekday_hour", "segments", "top_segments",
                   "lag_correlations", "correlations", "target_correlations", "describe"}
