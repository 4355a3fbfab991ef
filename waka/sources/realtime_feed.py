"""Realtime feed documents (S4, S5, S7 inputs) and their parsers.

``position_documents`` / ``update_documents`` render the events table as realtime
feed snapshots: one JSON document per tick holding an ``entity`` list, the way a
vehicle-positions / trip-updates endpoint answers. The rendering carries the dirty
cases the ingest must handle (string numbers, missing trip, bad start time, object
vs list ``stop_time_update``, missing label ...); which rows get which case is a
rule on the event's columns, so the SQL oracle can apply the same rules to the rows.

``parse_positions`` / ``parse_updates`` read any such documents (batch or stream):
``parse_json`` -> explode the entity array -> typed fields with JSON-type checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import local_start
from .tables import read_table

# Entities per snapshot document (a tick); bounds the per-document list.
TICK_SIZE = 50


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id", "user_id", "event_type", "value", "ts",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"), k.alias("k"),
        (F.col("event_id") / TICK_SIZE).cast("long").alias("tick_no"),
        (F.col("event_id") % TICK_SIZE).cast("int").alias("pos"),
    )


def _trip(bad_start: Column) -> Column:
    u = F.col("user_id")
    return F.struct(
        F.col("event_type").alias("trip_id"),
        F.when(bad_start, F.lit("25:10:00")).otherwise(F.date_format(F.col("ts").cast("timestamp"), "H:00:00")).alias("start_time"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd").alias("start_date"),
        F.lit(0).alias("schedule_relationship"),
        F.concat(F.lit("R"), F.length("event_type").cast("string")).alias("route_id"),
        (u % 2).cast("int").alias("direction_id"),
    )


def _vehicle_ref(with_label: Column) -> Column:
    u = F.col("user_id").cast("string")
    return F.struct(u.alias("id"), F.when(with_label, F.concat(F.lit("L"), u)).alias("label"),
                    F.concat(F.lit("P"), u).alias("license_plate"))


def _lat() -> Column:
    return F.lit(-36.9) + (F.col("event_id") % 97) / F.lit(970.0)


def _lon() -> Column:
    return F.lit(174.7) + (F.col("event_id") % 89) / F.lit(890.0)


def _by_tick(e: DataFrame) -> DataFrame:
    """Hash-partition events by tick once: JSON rendering spreads over the partitions, and the grouping into
    documents needs no second shuffle."""
    return e.repartition("tick_no")


def _documents(entities: DataFrame) -> DataFrame:
    """Group entity JSON strings into one feed document per tick (<= TICK_SIZE each)."""
    g = entities.groupBy("tick_no").agg(
        F.max("epoch").alias("header_ts"),
        F.array_sort(F.collect_list(F.struct("pos", "json"))).alias("ents"))
    body = F.concat(
        F.lit('{"status":"OK","response":{"header":{"timestamp":'), F.col("header_ts").cast("string"),
        F.lit(',"gtfs_realtime_version":"1.0"},"entity":['),
        F.array_join(F.transform("ents", lambda x: x["json"]), ","), F.lit(']},"error":null}'))
    return g.select("tick_no", body.alias("value"))


def position_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle-position snapshots (tick_no, value) derived from events."""
    e = _by_tick(_events(spark, sf_dir))
    u, k, eid = F.col("user_id"), F.col("k"), F.col("event_id")
    has_trip = eid % 41 != 0
    bad_start = eid % 53 == 0
    bearing_num = F.when(k % 5 != 0, ((u * 37) % 360).cast("int"))

    def entity(bearing: Column) -> Column:
        vehicle = F.struct(
            F.when(has_trip, _trip(bad_start)).alias("trip"),
            F.struct(_lat().alias("latitude"), _lon().alias("longitude"), bearing.alias("bearing"),
                     F.when(eid % 37 != 0, F.col("value")).alias("speed")).alias("position"),
            F.col("epoch").alias("timestamp"),
            _vehicle_ref(F.lit(True)).alias("vehicle"),
            F.when(k % 3 != 0, (k % 6).cast("int")).alias("occupancy_status"),
        )
        return F.struct(u.cast("string").alias("id"), vehicle.alias("vehicle"), F.lit(False).alias("is_deleted"))

    def entity_numeric_id(bearing: Column) -> Column:
        s = entity(bearing)
        return s.withField("id", u)

    as_string = k % 4 == 1
    json = (F.when(eid % 3 == 0, F.when(as_string, F.to_json(entity_numeric_id(bearing_num.cast("string"))))
                   .otherwise(F.to_json(entity_numeric_id(bearing_num))))
            .otherwise(F.when(as_string, F.to_json(entity(bearing_num.cast("string"))))
                       .otherwise(F.to_json(entity(bearing_num)))))
    return _documents(e.select("tick_no", "pos", "epoch", json.alias("json")))


def update_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-update snapshots (tick_no, value) derived from events; ``stop_time_update``
    is a list of two, an object, an empty list or a list of one, by rule."""
    e = _by_tick(_events(spark, sf_dir))
    u, k, eid = F.col("user_id"), F.col("k"), F.col("event_id")
    bad_start = eid % 53 == 0
    stu = F.struct(
        (u % 10).cast("int").alias("stop_sequence"),
        F.when(k % 2 == 1, F.struct(k.alias("delay"), (F.col("epoch") + 60).alias("time"),
                                    F.lit(0).alias("uncertainty"))).alias("departure"),
        F.concat(F.lit("S"), (u % 10).cast("string")).alias("stop_id"),
        F.lit(0).alias("schedule_relationship"),
    )
    other = F.struct(F.lit(99).cast("int").alias("stop_sequence"),
                     F.lit(None).cast("struct<delay:int,time:bigint,uncertainty:int>").alias("departure"),
                     F.lit("X").alias("stop_id"), F.lit(0).alias("schedule_relationship"))
    delay_int = (F.floor("value").cast("int") - 20)

    def entity(stu_value: Column, delay: Column) -> Column:
        tu = F.struct(_trip(bad_start).alias("trip"), stu_value.alias("stop_time_update"),
                      _vehicle_ref(eid % 31 != 0).alias("vehicle"), F.col("epoch").alias("timestamp"),
                      delay.alias("delay"))
        return F.struct(u.cast("string").alias("id"), tu.alias("trip_update"),
                        F.when(eid % 2 == 1, F.lit(False)).alias("is_deleted"))

    def render(stu_value):
        return F.when(eid % 5 == 0, F.to_json(entity(stu_value, delay_int.cast("string")))).otherwise(
            F.to_json(entity(stu_value, delay_int)))

    json = (F.when(k % 3 == 0, render(F.array(stu, other)))
            .when(k % 3 == 1, render(stu))
            .when(eid % 7 == 0, render(F.array().cast("array<struct<stop_sequence:int,stop_id:string>>")))
            .otherwise(render(F.array(stu))))
    return _documents(e.select("tick_no", "pos", "epoch", json.alias("json")))


# ------------------------------------------------------------------ landed documents
def read_documents(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """S4/S5 on landed files: ``value``, one snapshot document a line, or one a file (``multiline``: the document may span lines)."""
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=multiline)


def document_stream(spark: SparkSession, path: str, files_per_trigger: int = 50, multiline: bool = False) -> DataFrame:
    """The same as a stream of the files as they land."""
    return (spark.readStream.format("text").option("recursiveFileLookup", "true").option("wholetext", multiline)
            .option("maxFilesPerTrigger", files_per_trigger).load(path))


# ------------------------------------------------------------------ parsing
INT_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def _sources(paths, entity: str = "e"):
    """Spec paths -> (column, path) pairs; ``$._stu.x`` reads the chosen stop update."""
    out = []
    for p in paths:
        out.append(("_stu_obj", "$" + p[len("$._stu"):]) if p.startswith("$._stu") else (entity, p))
    return out


def _typed(x: Column, t: Column, kind: str) -> tuple[Column, Column]:
    """(value, type_ok) from a field's variant ``x`` and its JSON type ``t``: ints accept
    integral numbers and digit strings, floats accept numbers and numeric strings,
    strings only strings, bools only booleans. Conversions sit inside the branch of
    the type that needs them, so a row pays for one conversion per field."""
    is_str = t == "STRING"
    is_int = t.isin(*INT_TYPES)
    is_dec = t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")

    def text():
        return F.trim(F.try_variant_get(x, "$", "string"))

    if kind == "int":
        d = F.try_variant_get(x, "$", "double")
        dec_ok = is_dec & (d == F.floor(d))
        str_ok = is_str & text().rlike(r"^[+-]?[0-9]+$") & text().try_cast("long").isNotNull()
        val = (F.when(is_int, F.try_variant_get(x, "$", "long"))
               .when(dec_ok, F.try_variant_get(x, "$", "long"))
               .when(str_ok, text().try_cast("long")))
        return val, is_int | dec_ok | str_ok
    if kind == "float":
        str_ok = is_str & text().try_cast("double").isNotNull()
        val = F.when(is_int | is_dec, F.try_variant_get(x, "$", "double")).when(is_str, text().try_cast("double"))
        return val, is_int | is_dec | str_ok
    if kind == "bool":
        ok = t == "BOOLEAN"
        return F.when(ok, F.try_variant_get(x, "$", "boolean")), ok
    return F.when(is_str, F.try_variant_get(x, "$", "string")), is_str


def read_fields(df: DataFrame, spec) -> tuple[DataFrame, dict[str, Column]]:
    """Typed columns for every (name, kind, paths, required) of ``spec`` plus one rule
    column ``_<name>_ok`` per field (valid when true; a missing optional field is valid).

    Staged projections: each field's first (nested) path is read once; the fallback
    (flat) names are read only when it is absent; the JSON type is read once; the
    typed value is derived from those columns."""
    first = {f"__n_{n}": F.try_variant_get(F.col(c), p, "variant")
             for n, _, paths, _ in spec for c, p in _sources(paths)[:1]}
    df = df.withColumns(first)
    located = {}
    for n, _, paths, _ in spec:
        nested = F.col(f"__n_{n}")
        cands = [F.when(~F.is_variant_null(nested), nested)]
        for c, p in _sources(paths)[1:]:
            fb = F.try_variant_get(F.col(c), p, "variant")
            cands.append(F.when(~F.is_variant_null(fb), fb))
        located[f"__x_{n}"] = F.coalesce(*cands)
    df = df.withColumns(located)
    df = df.withColumns({f"__t_{n}": F.schema_of_variant(F.col(f"__x_{n}")) for n, _, _, _ in spec})
    cols, rules = {}, {}
    for n, kind, _, required in spec:
        val, ok = _typed(F.col(f"__x_{n}"), F.col(f"__t_{n}"), kind)
        cols[n] = val
        cols[f"_{n}_ok"] = F.when(F.col(f"__x_{n}").isNotNull(), ok).otherwise(F.lit(not required))
        rules[n] = F.col(f"_{n}_ok")
    df = df.withColumns(cols)
    return df.drop(*[f"__{k}_{n}" for n, _, _, _ in spec for k in "nxt"]), rules


def _documents_to_entities(docs: DataFrame) -> DataFrame:
    """(tick, pos, e) per entity; a document that is no JSON or has no entity list is one row with
    ``_no_entities`` set, which the rule ``document`` quarantines. The outer generator keeps the optimizer from adding a
    non-empty-array filter below it, which would parse every document a second time;
    rows without an entity are dropped by the callers' presence checks."""
    j = F.try_parse_json(F.col("value"))
    d = docs.select(F.try_variant_get(j, "$.response.header.timestamp", "long").alias("tick"),
                    F.try_variant_get(j, "$.response.entity", "array<variant>").alias("ents"))
    return d.select("tick", F.col("ents").isNull().alias("_no_entities"), F.posexplode_outer("ents").alias("pos", "e"))


POSITION_SPEC = [
    ("id", "int", ["$.id"], True),
    ("trip_id", "str", ["$.vehicle.trip.trip_id", "$.trip_id"], True),
    ("occupancy_status", "int", ["$.vehicle.occupancy_status", "$.occupancy_status"], False),
    ("bearing", "float", ["$.vehicle.position.bearing", "$.bearing"], False),
    ("latitude", "float", ["$.vehicle.position.latitude", "$.latitude"], True),
    ("longitude", "float", ["$.vehicle.position.longitude", "$.longitude"], True),
    ("speed", "float", ["$.vehicle.position.speed", "$.speed"], True),
    ("timestamp", "int", ["$.vehicle.timestamp", "$.timestamp"], True),
    ("route_id", "str", ["$.vehicle.trip.route_id", "$.route_id"], True),
    ("direction_id", "int", ["$.vehicle.trip.direction_id", "$.direction_id"], False),
]

UPDATE_SPEC = [
    ("is_deleted", "bool", ["$.is_deleted"], False),
    ("trip_id", "str", ["$.trip_update.trip.trip_id", "$.trip_id"], True),
    ("route_id", "str", ["$.trip_update.trip.route_id", "$.route_id"], True),
    ("direction_id", "int", ["$.trip_update.trip.direction_id", "$.direction_id"], False),
    ("schedule_relationship", "int", ["$.trip_update.trip.schedule_relationship", "$.schedule_relationship"], False),
    ("stop_sequence", "int", ["$._stu.stop_sequence", "$.stop_sequence"], True),
    ("stop_id", "str", ["$._stu.stop_id", "$.stop_id"], True),
    ("stop_schedule_relationship", "int", ["$._stu.schedule_relationship", "$.stop_schedule_relationship"], False),
    ("departure_delay", "int", ["$._stu.departure.delay", "$.departure_delay"], False),
    ("departure_time", "int", ["$._stu.departure.time", "$.departure_time"], False),
    ("departure_uncertainty", "int", ["$._stu.departure.uncertainty", "$.departure_uncertainty"], False),
    ("vehicle_id", "str", ["$.trip_update.vehicle.id", "$.vehicle_id"], False),
    ("label", "str", ["$.trip_update.vehicle.label", "$.label"], False),
    ("license_plate", "str", ["$.trip_update.vehicle.license_plate", "$.license_plate"], False),
    ("timestamp", "int", ["$.trip_update.timestamp", "$.timestamp"], True),
    ("delay", "int", ["$.trip_update.delay", "$.delay"], True),
]


def _start_time(v: Column, trip_path: str) -> tuple[Column, Column]:
    """X9 on the trip object: (instant or null, rule)."""
    sd = F.try_variant_get(v, f"{trip_path}.start_date", "string")
    st = F.try_variant_get(v, f"{trip_path}.start_time", "string")
    inst = local_start(sd, st)
    return inst, inst.isNotNull()


def _filled(path: str, known: str) -> Column:
    """Whether the entity has something other than null or an empty object at ``path``. The field ``known`` proves it for nearly
    all; only an object without it pays for the schema of the whole."""
    x = F.try_variant_get("e", path, "variant")
    proven = F.try_variant_get("e", f"{path}.{known}", "variant").isNotNull()
    return F.coalesce(x.isNotNull() & ~F.is_variant_null(x) & (proven | (F.schema_of_variant(x) != "OBJECT<>")), F.lit(False))


def parse_positions(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """S4 + P12 + X16/X17: one typed row per entity carrying a trip; returns the rows
    and the validation rules (Q5) as boolean columns."""
    ents = _documents_to_entities(docs)
    ents = ents.where(F.col("_no_entities") | _filled("$.vehicle.trip", "trip_id"))
    df, rules = read_fields(ents, POSITION_SPEC)
    rules["document"] = ~F.col("_no_entities")
    inst, ok = _start_time(F.col("e"), "$.vehicle.trip")
    df = df.withColumns({"start_time": inst, "_start_time_ok": ok})
    rules["start_time"] = F.col("_start_time_ok")
    return df, rules


def parse_updates(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """A list-valued ``stop_time_update`` contributes its first element (an empty
    list contributes nothing, so its stop fields are missing)."""
    ents = _documents_to_entities(docs)
    ents = ents.where(F.col("_no_entities") | _filled("$.trip_update", "trip"))
    raw = F.try_variant_get("e", "$.trip_update.stop_time_update", "variant")
    element = F.try_variant_get("e", "$.trip_update.stop_time_update[0]", "variant")
    is_object = F.try_variant_get("e", "$.trip_update.stop_time_update.stop_id", "variant").isNotNull()
    # an element proves a list, a stop an object; only what has neither pays for its schema
    first = (F.when(element.isNotNull(), element).when(is_object, raw)
             .when(F.schema_of_variant(raw).startswith("ARRAY"), F.lit(None).cast("variant")).otherwise(raw))
    # the chosen stop_time_update sits next to the entity; "$._stu..." paths read it
    ents = ents.withColumn("_stu_obj", first)
    v = F.col("e")
    df, rules = read_fields(ents, UPDATE_SPEC)
    rules["document"] = ~F.col("_no_entities")
    df = df.withColumn("is_deleted", F.coalesce(F.col("is_deleted"), F.lit(False)))
    inst, ok = _start_time(v, "$.trip_update.trip")
    df = df.withColumns({"start_time": inst, "_start_time_ok": ok})
    rules["start_time"] = F.col("_start_time_ok")
    return df, rules
