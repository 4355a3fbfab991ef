"""Steps whose rows are computed once: nothing derived is planned again above a stored or generated row."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from waka.operators import features as fe
from waka.operators import profile as pr
from waka.plans import catalog_network as cn
from waka.plans import catalog_profile as cp
from waka.operators import quality as qa
from waka.operators import versions as vs
from waka.plans import catalog_tables as ct
from waka.plans import ingest, weekly
from waka.plans.catalog_realtime import holidays
from waka.session import METHOD_LIMIT, compiled_methods, scratch_path
from waka.sources import realtime_feed as rf
from waka.sources import transit_views as tv
from waka.streaming import merge_stream as ms

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_target_slice_reads_a_stored_matrix(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(40, len(cp.NUMERIC_COLS)))
    rows = spark.createDataFrame(values.tolist(), ", ".join(f"`{c}` double" for c in cp.NUMERIC_COLS))
    monkeypatch.setattr(cp, "train", lambda spark, sf: rows)
    got = cp.a18(spark, SF)
    assert "Python" not in _plan(got) and "MapInPandas" not in _plan(got)
    r = np.corrcoef(values.T)
    at = {c: i for i, c in enumerate(cp.NUMERIC_COLS)}
    found = got.collect()
    assert len(found) == 2 * (len(cp.NUMERIC_COLS) - 2)
    assert all(abs(x["r"] - r[at[x["feature"]], at[x["target"]]]) < 1e-5 for x in found)
    assert {x["target"] for x in found} == set(pr.TARGET_COLS)


def test_export_of_no_trip(spark, monkeypatch):
    monkeypatch.setattr(cn, "ROUTES", ["no such route"])
    got = entry.queries()["K4_json_csv_export"](spark, SF)
    assert got.columns == ct.TRIP_COLS and got.collect() == []


def test_quarantine_counts_read_stored_rows(spark):
    got = entry.queries()["Q5_quarantine_counts"](spark, SF)
    assert "variant" not in _plan(got)
    assert {r["feed"]: r["n_valid"] + r["n_rejected"] > 0 for r in got.collect()} == {"positions": True, "updates": True}


def test_stream_merge_filters_computed_errors(spark, tmp_path, monkeypatch):
    landing = tmp_path / "documents"
    landing.mkdir()
    (landing / "one.txt").write_text('{"response": {"header": {"timestamp": 1704067200}, "entity": []}}\n')
    monkeypatch.setattr(ms, "document_stream", lambda spark, path, *_: spark.read.text(path))     # the plan of the same rows as a batch
    merged = ms.merge_streams(spark, str(landing), str(landing), tv.realtime_trips(spark, SF), tv.calendar(spark, SF), holidays(spark))
    filters = [line for line in _plan(merged).splitlines() if "Filter" in line and "size(" in line]
    assert len(filters) == 2 and not any("variant_get" in line for line in filters)


def test_staging_neither_shuffles_nor_sorts_whole_rows(spark, monkeypatch):
    """K3: the rows are written as they come; repeated keys are counted on the staged keys, null keys among them."""
    plans, write = [], vs.write_parts
    monkeypatch.setattr(vs, "write_parts", lambda df, *a: (plans.append(_plan(df)), write(df, *a))[1])
    schema = "id bigint, timestamp bigint, obs_year int, trip_id string, segment_id string, speed double"
    rows = [(1, 1704700000, 2024, "a", "0-1", 1.0), (2, 1704700000, 2024, "a", "0-1", None), (None, 1704700000, 2024, "b", "0-1", 2.0)]
    parts, report = weekly.stage(spark.createDataFrame(rows, schema), scratch_path(spark, "staged"))
    assert (report.rows, report.null_counts["id"], report.null_counts["speed"], len(parts)) == (3, 1, 1, 1)
    assert "Window" not in plans[0]
    twice = [*rows, rows[0], rows[0], rows[2]]
    with pytest.raises(ValueError, match="3 duplicate"):
        weekly.stage(spark.createDataFrame(twice, schema), scratch_path(spark, "staged"))
    assert weekly.stage(spark.createDataFrame([], schema), scratch_path(spark, "staged"))[1].rows == 0


def test_training_set_reads_stored_averages(spark):
    """The averages come from one pass over the locations and are rounded in their own small table."""
    from waka.plans import catalog_features as cf
    ts = cf.training_of_all_weeks(spark, SF)
    plan = _plan(ts)
    assert "sum(" not in plan
    assert not [line for line in plan.splitlines() for c in fe.avg_column_names() if f"round(({c}" in line or f"round({c}" in line]
    assert plan.count("Join") <= 4                 # the carried rows, and one join with the averages
    assert "Exchange hashpartitioning(week" not in ts._jdf.queryExecution().executedPlan().toString()


def test_errors_are_computed_by_compiled_code(spark):
    rows = spark.createDataFrame([(1, True, None), (2, False, True), (3, True, True)], "id int, a boolean, b boolean")
    marked = qa.with_errors(rows, {"a": F.col("a"), "b": F.col("b")})
    assert {r["id"]: r["errors"] for r in marked.collect()} == {1: ["b"], 2: ["a"], 3: []}
    assert "lambda" not in _plan(marked)           # a higher-order function and all in its arguments are interpreted


def test_entities_of_odd_shapes(spark):
    """Trips, updates and stop updates without the fields that usually prove them."""
    def doc(entities):
        return spark.createDataFrame([(json.dumps({"response": {"header": {"timestamp": 5}, "entity": entities}}),)], "value string")

    trips = [{}, None, "x", [], {"route_id": "R"}, {"trip_id": None}, {"trip_id": "T"}]
    got, _ = rf.parse_positions(doc([{"vehicle": {"trip": t}} for t in trips]))
    assert [(r["pos"], r["trip_id"], r["route_id"]) for r in got.orderBy("pos").collect()] == [
        (2, None, None), (3, None, None), (4, None, "R"), (5, None, None), (6, "T", None)]
    updates = [{}, None, "x", {"delay": 4}, {"trip": None}]
    got, _ = rf.parse_updates(doc([{"trip_update": u} for u in updates]))
    assert [(r["pos"], r["delay"]) for r in got.orderBy("pos").collect()] == [(2, None), (3, 4), (4, None)]
    stops = [[], [None, {"stop_id": "S"}], {"stop_sequence": 3}, {"stop_id": "S"}, [{"stop_sequence": 4}], {}, "x", None]
    got, _ = rf.parse_updates(doc([{"trip_update": {"delay": 1, "stop_time_update": x}} for x in stops]))
    assert [(r["stop_sequence"], r["stop_id"]) for r in got.orderBy("pos").collect()] == [
        (None, None), (None, None), (3, None), (None, "S"), (4, None), (None, None), (None, None), (None, None)]


def test_feed_is_parsed_by_methods_that_are_compiled(spark, monkeypatch):
    name, seen, write = "spark.sql.codegen.hugeMethodLimit", [], ingest.materialize
    monkeypatch.setattr(ingest, "materialize", lambda df, *a: (seen.append((spark.conf.get(name), _plan(df))), write(df, *a))[1])
    before = spark.conf.get(name)
    ingest.valid_feed(rf.update_documents(spark, SF), rf.parse_updates, ingest.UPDATE_OUT, "updates")
    assert [limit for limit, _ in seen] == [METHOD_LIMIT] and spark.conf.get(name) == before
    with pytest.raises(KeyError), compiled_methods(spark):
        raise KeyError
    assert spark.conf.get(name) == before
