"""Sharding (1): a Feistel permutation of global row numbers.

A row's place in the shuffled order depends on its row number, the number of rows and the
seed alone: shard and slot are computed, not looked up, and ``row_at`` inverts them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import CRC_TABLE, crc_sql, number_rows, read

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit finaliser as round function."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64), seed & 0xFFFFFFFF)]


def _round_trip(x: np.ndarray, side: int, seed: int, back: bool) -> np.ndarray:
    """One pass through the network over [0, side * side), or back."""
    m = np.uint64(side)
    left, right = x // m, x % m
    keys = _keys(seed)
    if not back:
        for k in keys:
            left, right = right, (left + _mix(right, k) % m) % m
    else:
        for k in reversed(keys):
            left, right = (right + m - _mix(left, k) % m) % m, left
    return left * m + right


def permute(x: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """A permutation of 0 .. n-1 (or its inverse). The network works on the next square;
    a value that falls outside walks on along its cycle until it is inside."""
    out = np.asarray(x, dtype=np.uint64)
    side = math.isqrt(max(n, 1) - 1) + 1
    out = _round_trip(out, side, seed, back)
    while (far := np.flatnonzero(out >= n)).size:
        out[far] = _round_trip(out[far], side, seed, back)
    return out.astype(np.int64)


def row_at(shard: int, slot: int, n: int, n_shards: int, seed: int) -> int:
    """The row number that holds a shard's slot."""
    return int(permute(np.array([slot * n_shards + shard]), n, seed, back=True)[0])


def shard_rows(rows: DataFrame, *order: Column, n_shards: int, seed: int = 20) -> DataFrame:
    """``rows`` with ``shard`` (int, 0 .. n_shards-1) and ``slot`` (long, gapless from 0 in each shard).

    Rows are numbered in ``order``, shuffled by the permutation and dealt in turn, so shard sizes
    are at most one apart. Nulls sort first; equal rows get places of their own; an empty table
    gives an empty result; columns named shard or slot are replaced.
    """
    kept = rows.drop("shard", "slot", "__row_no")
    numbered = number_rows(kept, *order, name="__row_no")
    n = numbered.count()

    @F.pandas_udf("long")
    def place(no: pd.Series) -> pd.Series:
        return pd.Series(permute(no.to_numpy(), n, seed))

    return (numbered.withColumn("__place", place("__row_no"))
            .withColumn("shard", (F.col("__place") % n_shards).cast("int"))
            .withColumn("slot", F.expr(f"__place div {n_shards}"))
            .drop("__place", "__row_no"))


def op1_sharding(spark: SparkSession, sf_dir: str, n_shards: int = 24) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    return shard_rows(docs, F.col("doc_id"), n_shards=n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _sql_times(x: str, factor: int) -> str:
    """x times a factor modulo 2 ** 64."""
    return f"((({x})::UHUGEINT * {factor}::UHUGEINT) % {1 << 64}::UHUGEINT)::UBIGINT"


def _sql_round(inner: str, key: int) -> str:
    """One round over rows (no, n, side, l, r) of a subquery: left and right are swapped, left gains the mixed right. A layer for each step."""
    steps = [_sql_times(f"((r::UHUGEINT + {key}::UHUGEINT) % {1 << 64}::UHUGEINT)", 0x9E3779B97F4A7C15), _sql_times("xor(m, m >> 30)", 0xBF58476D1CE4E5B9),
             _sql_times("xor(m, m >> 27)", 0x94D049BB133111EB)]
    q = inner
    for e in steps:
        q = f"SELECT no, n, side, step, l, r, {e} AS m FROM ({q})"
    return f"SELECT no, n, side, step, r AS l, (l + xor(m, m >> 31) % side) % side AS r FROM ({q})"


def _oracle(n_shards: int = 24, seed: int = 20) -> str:
    q = "SELECT no, n, side, step, x // side AS l, x % side AS r FROM walk WHERE step = 0 OR x >= n"
    for key in _keys(seed):
        q = _sql_round(q, key)
    return f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1)::UBIGINT AS no, (count(*) OVER ())::UBIGINT AS n FROM documents),
walk AS (
  SELECT no, n, (floor(sqrt(n - 1)) + 1)::UBIGINT AS side, 0 AS step, no AS x FROM d
  UNION ALL SELECT no, n, side, step + 1, l * side + r FROM ({q}))
SELECT doc_id, (coalesce(octet_length(encode(text)), 0) + 8)::BIGINT AS size, {crc_sql("text")} AS text_crc32, 'rows' AS law,
       (x % {n_shards})::INT AS shard, (x // {n_shards})::BIGINT AS slot, NULL::INT AS grown_shard
FROM d JOIN walk USING (no), tab WHERE step > 0 AND x < d.n
"""


ORACLE = _oracle()
