"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waka.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A table of at most so many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000
#: A table whose values take at most so many bytes is broadcast.
BROADCAST_BYTES = 16 << 20

_POS_BITS = 33   # monotonically_increasing_id: partition << 33 | position


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column, pattern: str = WORD) -> Column:
    """Array of the words of a text; null counts as empty. Runs of a negated class are what a split by the class leaves, and are found
    that way: it takes a tenth of the time of their extraction."""
    whole = F.coalesce(text, F.lit(""))
    if pattern.startswith("[^") and pattern.endswith("]+") and "]" not in pattern[:-2]:
        return F.array_remove(F.split(whole, f"[{pattern[2:]}"), "")
    return F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))


def shingles(w: Column, n: int = 5) -> Column:
    """64-bit hashes of each run of ``n`` words, in order; a shorter text is one shingle, an empty one none."""

    def of(v: Column) -> Column:
        run = F.transform(F.sequence(F.lit(0), F.size(v) - n), lambda i: F.xxhash64(*[F.get(v, i + k) for k in range(n)]))
        return F.when(F.size(v) >= n, run).when(F.size(v) > 0, F.array(F.xxhash64(F.array_join(v, " ")))).otherwise(
            F.array().cast("array<bigint>"))

    return let(w, of)


def _bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value: 8 for a number, the length of a text, the sum of what an array or struct holds."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        own = F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        fixed = not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType))
        own = F.size(value) * 8 if fixed else F.aggregate(value, F.lit(0).cast("long"), lambda s, x: s + _bytes(x, kind.elementType))
    elif isinstance(kind, T.StructType):
        own = sum((_bytes(value[f.name], f.dataType) for f in kind), F.lit(0).cast("long"))
    else:
        return F.lit(8).cast("long")
    return F.greatest(F.coalesce(own, F.lit(0)), F.lit(0)).cast("long") + 8


def is_small(table: DataFrame) -> bool:
    """Whether the bytes of a stored table are proven to stay within BROADCAST_BYTES: its rows are added up, and the more of them than
    could be small aren't read."""
    most = BROADCAST_BYTES // (8 * max(1, len(table.columns)))
    size = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in table.schema), F.lit(0).cast("long"))
    n, total = table.limit(most + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return n <= most and (total or 0) <= BROADCAST_BYTES


def small(table: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast only if its measured size proves it small."""
    return F.broadcast(table) if is_small(table) else table


def number_rows(df: DataFrame, *order: Column, name: str = "row_no") -> DataFrame:
    """Rows numbered 0, 1, ... in the given order without a one-task window.

    The rows are range-partitioned and sorted, written once with their place in their
    partition, and a running sum over the partitions' counts (one row per partition)
    gives each partition its first number. Ties of ``order`` are broken by a hash of the whole row,
    then by scan position, so that only equal rows can trade places and equal rows can be split.
    """
    cols = df.columns
    tied = df.select("*", F.xxhash64(*[F.col(f"`{c}`") for c in cols]).alias("__tie"),
                     F.monotonically_increasing_id().alias("__scan"))
    keys = [*order, F.col("__tie"), F.col("__scan")]
    stored = materialize(
        tied.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select(*[F.col(f"`{c}`") for c in cols], F.monotonically_increasing_id().alias("__place")), "numbered")
    part = F.shiftright(F.col("__place"), _POS_BITS)
    first = (stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
             .select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(
                 Window.unboundedPreceding, -1)), F.lit(0)).alias("__first")))
    # one row per partition of the stored table
    return (stored.join(F.broadcast(first), part == F.col("__part"))
            .select(*[F.col(f"`{c}`") for c in cols],
                    (F.col("__first") + F.col("__place").bitwiseAND((1 << _POS_BITS) - 1)).alias(name)))


#: DuckDB: table tab with list t, the 256 steps of the crc32 polynomial.
CRC_TABLE = """tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc_sql(text: str) -> str:
    """DuckDB: unsigned crc32 of a text's UTF-8 bytes, beside table tab."""
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, 2 * octet_length(encode({text})), 2), "
            f"lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")
