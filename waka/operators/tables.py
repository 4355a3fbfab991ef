"""Table maintenance on parquet (K1-K4, M1-M4) and table reads.

Without a transactional table format, writes are copy-on-write: the new state of the
touched data is written to a fresh location under the shared checkpoint folder and
only then swapped in (dynamic partition overwrite; ``versions`` has the published kind).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.strings import split_trim
from ..session import scratch_path


# ------------------------------------------------------------------ file-system helpers (Hadoop FS, any scheme)
def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def table_state(spark: SparkSession, sf_dir: str, table: str) -> tuple:
    """Names, sizes and times of a base table's files: differs when a file has changed."""
    fs, p = _fs(spark, f"{sf_dir}/{table}.parquet")
    status = fs.getFileStatus(p)
    files = list(fs.listStatus(p)) if status.isDirectory() else [status]
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.writeBytes(text.encode("ascii", "backslashreplace").decode("ascii"))
    out.close()


def read_text_file(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path).collect())


# ------------------------------------------------------------------ merge semantics
def one_row_per_key(new: DataFrame, keys) -> DataFrame:
    """``new``, failing when it is run if a key repeats (which of the rows should win is undefined)."""
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    checked = new.withColumn("_copies", copies).where(
        F.assert_true(F.col("_copies") == 1, F.lit(f"the new rows repeat a key of {tuple(keys)}")).isNull())
    return checked.drop("_copies")


def upsert(old: DataFrame, new: DataFrame, keys, stamp: tuple[str, object] | None = None) -> DataFrame:
    """K2: new rows replace old rows with the same key (every non-key column is
    overwritten); old rows absent from ``new`` are kept. A key that repeats in ``new`` is an error. ``stamp`` (column, value)
    marks when a row was last written: new rows get the value, kept rows keep theirs. When every
    column is a key the upsert degenerates to insert-ignore."""
    keys = list(keys)
    if set(old.columns) <= set(keys):
        return old.unionByName(new.join(old, keys, "left_anti")).distinct()
    new = one_row_per_key(new, keys)
    if stamp:
        new = new.withColumn(stamp[0], F.lit(stamp[1]))
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*old.columns))


# ------------------------------------------------------------------ writers
def first_rows(batch: DataFrame, keys, order) -> DataFrame:
    """The first row of each key in ``order`` (a partial aggregate, so a hot key is combined before the shuffle)."""
    rest = [c for c in batch.columns if c not in keys]
    first = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_r.`{c}`").alias(c) for c in batch.columns])


def append_new_rows(spark: SparkSession, path: str, batch: DataFrame, keys, partition_by=None, order=None) -> int:
    """K1 sink: append the rows of ``batch`` whose key is not yet in the table at ``path``.

    Of the rows that share a key the first in ``order`` is kept (any, without an order). Keys are compared null-safe, so a
    null is a value like any other and a replay stores nothing twice. When the table is partitioned (e.g. by observation
    date) and the partition column is part of the key, only the touched partitions of the
    existing side are read. Returns the number of appended rows."""
    keys = list(keys)
    b = first_rows(batch, keys, order).drop(*order) if order else batch.dropDuplicates(keys)

    def lacking(rows: DataFrame, other: DataFrame, cols, how: str) -> DataFrame:
        other = other.select(*[F.col(c).alias(f"_{c}") for c in cols])
        return rows.join(other, reduce(lambda x, y: x & y, [rows[c].eqNullSafe(other[f"_{c}"]) for c in cols]), how)

    if path_exists(spark, path):
        existing = spark.read.parquet(path).select(*keys)
        if partition_by:   # read only the partitions this batch touches (partition pruning)
            existing = lacking(existing, b.select(*partition_by).distinct(), list(partition_by), "left_semi")
        b = lacking(b, existing, keys, "left_anti")
    staged = scratch_path(spark, "append")
    w = b.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(staged)
    staged_df = spark.read.schema(b.schema).parquet(staged)
    n = staged_df.count()
    if n:
        w2 = staged_df.write.mode("append")
        (w2.partitionBy(*partition_by) if partition_by else w2).parquet(path)
    return n


# ------------------------------------------------------------------ row operations on a keyed table (M1-M4)
def create_rows(table: DataFrame, new: DataFrame, keys) -> DataFrame:
    """M1: append new rows; an existing key is an error (raised after a semi-join count)."""
    keys = list(keys)
    clash = new.join(table.select(*keys), keys, "left_semi").limit(1).count()
    if clash:
        raise ValueError("duplicate key on create")
    return table.unionByName(new.select(*table.columns))


def get_rows(table: DataFrame, requested: DataFrame, keys) -> DataFrame:
    """M2: one row per requested key; columns null when the key is missing."""
    return requested.select(*keys).distinct().join(table, list(keys), "left")


def update_rows(table: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """M3: overwrite the non-key columns of matching rows; ``updated`` flags them.
    Update rows for missing keys change nothing (reported as not found)."""
    keys = list(keys)
    other = [c for c in table.columns if c not in keys]
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in other]).withColumn("_hit", F.lit(True))
    j = table.join(u, keys, "left")
    return j.select(*keys, *[F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) for c in other],
                    F.coalesce(F.col("_hit"), F.lit(False)).alias("updated"))


def update_report(table: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """M3 result per requested key: found or not."""
    keys = list(keys)
    t = table.select(*keys).withColumn("found", F.lit(True))
    return updates.select(*keys).distinct().join(t, keys, "left").select(
        *keys, F.coalesce("found", F.lit(False)).alias("found"))


def delete_rows(table: DataFrame, keys_df: DataFrame, key: str, restrict: list[DataFrame] = ()) -> tuple[DataFrame, DataFrame]:
    """M4: delete rows by key unless another table still references them (restrict).

    Returns (remaining table, report(key, found, deleted)). Cascading deletes of
    child rows are ``cascade(child, report)``."""
    req = keys_df.select(key).distinct()
    blocked = None
    for ref in restrict:
        r = ref.select(key).distinct()
        blocked = r if blocked is None else blocked.unionByName(r)
    found = req.join(table.select(key), key, "left_semi")
    deletable = found if blocked is None else found.join(blocked, key, "left_anti")
    remaining = table.join(deletable, key, "left_anti")
    rep = req.join(found.withColumn("found", F.lit(True)), key, "left").join(
        deletable.withColumn("deleted", F.lit(True)), key, "left").select(
        key, F.coalesce("found", F.lit(False)).alias("found"), F.coalesce("deleted", F.lit(False)).alias("deleted"))
    return remaining, rep


def cascade(child: DataFrame, report: DataFrame, key: str) -> DataFrame:
    """M4 cascade: drop child rows whose parent was deleted."""
    return child.join(report.where("deleted").select(key), key, "left_anti")


# ------------------------------------------------------------------ reads
def filter_lists(df: DataFrame, int_cols=("direction_id",), **lists) -> DataFrame:
    """P3 + X7: optional conjunctive IN-filters, each given as a comma-separated string
    (or an int); ``None`` means no filter."""
    for col, val in lists.items():
        if val is None:
            continue
        items = split_trim(F.lit(str(val)))
        if col in int_cols:
            items = F.transform(items, lambda x: x.cast("int"))
        df = df.where(F.array_contains(items, F.col(col)))
    return df


def page(df: DataFrame, order, offset: int = 0, limit: int | None = None) -> DataFrame:
    """O2: ordered page (offset, then limit)."""
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out
