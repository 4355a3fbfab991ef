"""Versioned tables on parquet: immutable part folders and a manifest published last (K3, K5, T5).

A table is a list of parts; a part has a key (a week, a key bucket) and the folders that hold its rows.
A job writes new folders for the parts it changes and then publishes one manifest that
names, for every table, the folders of every part: readers see the version before until the new one is
whole, parts that didn't change keep their folders, and a job that fails leaves nothing but
unnamed folders. Manifests are numbered; two jobs that publish the same number clash, and the
second one fails.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path
from .tables import _fs, write_text_file

_NAME = "manifest-{:08d}.json"


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def current(spark: SparkSession, root: str) -> dict:
    """The manifest published last: version, at (the job's own stamp) and tables; version 0 is empty."""
    found = max((n for n in _children(spark, root) if n.startswith("manifest-")), default=None)
    if found is None:
        return {"version": 0, "at": None, "tables": {}}
    return json.loads("\n".join(r.value for r in spark.read.text(f"{root.rstrip('/')}/{found}").collect()))


def publish(spark: SparkSession, root: str, seen: dict, changes: dict[str, dict], at=None) -> dict:
    """Publish ``seen`` (the manifest this job started from) with ``changes``: table -> {schema, parts}, where a
    part mapped to None is dropped. The manifest appears whole, by a rename, or not at all."""
    tables = {name: {"schema": t["schema"], "parts": dict(t["parts"])} for name, t in seen["tables"].items()}
    for name, change in changes.items():
        t = tables.setdefault(name, {"schema": change["schema"], "parts": {}})
        t["schema"] = change["schema"]
        for key, paths in change["parts"].items():
            if paths:
                t["parts"][key] = paths
            else:
                t["parts"].pop(key, None)
    state = {"version": seen["version"] + 1, "at": at if at is not None else seen["at"], "tables": tables}
    base = root.rstrip("/")
    draft, final = scratch_path(spark, "manifest"), f"{base}/{_NAME.format(state['version'])}"
    fs, target = _fs(spark, final)
    fs.mkdirs(_fs(spark, base)[1])
    write_text_file(spark, draft, json.dumps(state))
    if fs.exists(target) or not fs.rename(_fs(spark, draft)[1], target):
        raise RuntimeError(f"version {state['version']} of {base} was published by another job")
    return state


def write_parts(df: DataFrame, key: str, folder: str) -> dict[str, list[str]]:
    """Write ``df`` below ``folder`` by its column ``key``; returns the folders by key. The column itself isn't stored."""
    df.write.mode("overwrite").partitionBy(key).parquet(folder)
    head = f"{key}="
    return {unquote(n[len(head):]): [f"{folder}/{n}"] for n in _children(df.sparkSession, folder) if n.startswith(head)}


def read_parts(spark: SparkSession, state: dict, table: str, keys=None, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a table of a manifest, of the parts ``keys`` only if given (no other folder is opened)."""
    known = state["tables"].get(table)
    if known is None:
        if schema is None:
            raise KeyError(f"no table {table} in version {state['version']}")
        return spark.createDataFrame([], schema)
    schema = T.StructType.fromJson(json.loads(known["schema"]))
    paths = [p for k, ps in known["parts"].items() if keys is None or k in keys for p in ps]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
