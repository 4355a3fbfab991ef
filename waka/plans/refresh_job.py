"""T5: the static refresh as one job: C1 -> Q3 -> K2 -> K5.

The five tables of a refresh are stored by key bucket. Each has two kinds of parts:
``<table>``, the rows of the feed read last, with a digest of their non-key columns, and
``<table>.kept``, rows of earlier feeds that are absent from it (an upsert keeps them).

A refresh checks the key of every table (Q3) and aborts on a repeated one. It then compares stored and
new feed by key and digest, reading these columns alone, and rewrites only the buckets that hold a
new, changed or vanished row. One manifest publishes all five tables together (K5). An upsert
also refreshes ``created_at`` of every row of the feed: rows of the feed read last take it from the
manifest, and only a row that vanishes from the feed has it written down. So a second refresh from an
unchanged feed writes nothing but a manifest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as qa
from ..operators import versions as vs
from ..session import materialize, scratch_path
from .static_refresh import RefreshResult

KEYS = {"calendar": ["service_id"], "stops": ["stop_id"], "trips": ["trip_id"], "segments": ["segment_id"],
        "trip_segments": ["trip_id", "segment_id"]}
STAMPED = {"trips"}        # tables with created_at
BUCKETS = 16


def tables_of(result: RefreshResult) -> dict[str, DataFrame]:
    return {name: getattr(result, name) for name in KEYS}


def _prepared(df: DataFrame, keys, buckets: int) -> DataFrame:
    """``df`` with ``_digest`` of the non-key columns and ``_bucket`` of the key."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    digest = F.md5(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})) if rest else F.lit("")
    return df.withColumns({"_digest": digest, "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")})


def changes_of(fresh: DataFrame, stored: DataFrame, keys) -> DataFrame:
    """Keys with their bucket and state: new, changed, gone or same."""
    on = ["_bucket", *keys]
    both = fresh.select(*on, F.col("_digest").alias("_new")).join(stored.select(*on, F.col("_digest").alias("_old")), on, "full_outer")
    state = (F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "gone")
             .when(F.col("_old") != F.col("_new"), "changed").otherwise("same"))
    return both.select(*on, state.alias("state"))


def _merge_table(spark: SparkSession, seen: dict, name: str, fresh: DataFrame, buckets: int) -> tuple[dict, dict[str, int]]:
    """The part changes of a table and of its kept rows, and the number of keys by state."""
    keys, kept_name = KEYS[name], f"{name}.kept"
    schema = fresh.schema
    kept_schema = fresh.drop("_digest").withColumn("created_at", F.lit(0).cast("long")).schema
    stored = vs.read_parts(spark, seen, name, schema=schema)
    states = changes_of(fresh, stored, keys).groupBy("_bucket", "state").count().collect()      # buckets x 4 rows at most
    counts = {s: sum(r["count"] for r in states if r["state"] == s) for s in ("new", "changed", "gone", "same")}
    touched = sorted({r["_bucket"] for r in states if r["state"] != "same"})
    now, kept = {}, {}
    if touched:
        here = F.col("_bucket").isin(touched)
        current = fresh.where(here)
        gone = stored.where(here).join(current.select(*keys), keys, "left_anti").withColumn("created_at", F.lit(seen["at"]).cast("long"))
        before = vs.read_parts(spark, seen, kept_name, touched, schema=kept_schema)
        left = gone.select(*kept_schema.names).unionByName(before.join(current.select(*keys), keys, "left_anti"))
        by = F.col("_bucket").alias("_part")
        now = vs.write_parts(current.select("*", by), "_part", scratch_path(spark, f"refresh-{name}"))
        kept = vs.write_parts(left.select("*", by), "_part", scratch_path(spark, f"refresh-{kept_name}"))
    return {name: {"schema": schema.json(), "parts": {b: now.get(b) for b in touched}},
            kept_name: {"schema": kept_schema.json(), "parts": {b: kept.get(b) for b in touched}}}, counts


def publish_refresh(spark: SparkSession, root: str, tables: dict[str, DataFrame], at: int, buckets: int = BUCKETS) -> DataFrame:
    """Q3, K2 and K5 for the tables of one refresh; ``at`` is its time (epoch seconds).

    Returns (table_name, n_new, n_changed, n_gone, n_same, n_rewritten parts); raises, before anything is published, if a key repeats.
    """
    fresh = {n: materialize(_prepared(tables[n], KEYS[n], buckets), f"feed-{n}") for n in KEYS}
    wrong = [r for r in qa.unique_report({n: (fresh[n], KEYS[n]) for n in KEYS}).collect() if not r["ok"]]
    if wrong:
        raise ValueError("keys repeat, nothing is published: " + ", ".join(
            f"{r['table_name']} has {r['n_rows']:,} rows and {r['n_keys']:,} keys" for r in wrong))
    seen = vs.current(spark, root)
    if seen["at"] is not None and at <= seen["at"]:
        raise ValueError("a refresh must be later than the one before")
    changes, rows = {}, []
    for n in KEYS:
        change, c = _merge_table(spark, seen, n, fresh[n], buckets)
        changes |= change
        rows.append((n, c["new"], c["changed"], c["gone"], c["same"], len(change[n]["parts"])))
    vs.publish(spark, root, seen, changes, at)
    return spark.createDataFrame(rows, "table_name string, n_new long, n_changed long, n_gone long, n_same long, n_rewritten int")


def read_refreshed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the version published last: the rows of the last feed and those kept from earlier ones."""
    state = vs.current(spark, root)
    helpers = ["_digest", "_bucket"]
    now = vs.read_parts(spark, state, name).drop(*helpers).withColumn("created_at", F.lit(state["at"]).cast("long"))
    out = now.unionByName(vs.read_parts(spark, state, f"{name}.kept").drop(*helpers))
    return out if name in STAMPED else out.drop("created_at")


def table_sizes(spark: SparkSession, root: str) -> DataFrame:
    """table_name and n_rows of the version published last."""
    one = lambda n: read_refreshed(spark, root, n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
    return reduce(DataFrame.unionByName, [one(n) for n in KEYS])
