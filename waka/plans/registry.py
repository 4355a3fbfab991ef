"""Registry of named queries: one per operator id of the inventory.

Each entry holds the Spark implementation ``fn(spark, sf_dir) -> DataFrame`` and, when
the operator is expressible in plain SQL, the DuckDB oracle text run on the same base
tables. Aggregated doubles are rounded to 6 places on both sides so that summation
order does not decide equality.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
NOTES: dict[str, str] = {}


def register(key: str, sql: str | None = None, note: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        if note:
            NOTES[key] = note
        return fn

    return deco


def round_doubles(df: DataFrame, places: int = 6, only=None) -> DataFrame:
    """Round double columns (all, or the ``only`` list) for engine-neutral comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (only is None or f.name in only):
            cols.append(F.round(F.col(f"`{f.name}`"), places).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
