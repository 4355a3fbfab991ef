"""Static feed files (S1, S2, S3) and JSON documents.

A feed table is a CSV with a header row. Its columns are bound **by name** from the
header (an explicit schema would bind by position): the reader takes every column as
a string and the caller casts the ones it uses, so projection and filters still
reach the scan.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types of the feed columns the jobs use (others stay strings).
FEED_TYPES = {
    "calendar": {"monday": "int", "tuesday": "int", "wednesday": "int", "thursday": "int", "friday": "int",
                 "saturday": "int", "sunday": "int"},
    "stops": {"location_type": "int", "stop_lat": "double", "stop_lon": "double"},
    "stop_times": {"stop_sequence": "int"},
    "trips": {"direction_id": "int"},
    "shapes": {"shape_pt_lat": "double", "shape_pt_lon": "double", "shape_pt_sequence": "int"},
    "routes": {},
}
REQUIRED_MEMBERS = ["calendar", "stops", "stop_times", "trips", "shapes", "routes"]


def read_feed_csv(spark: SparkSession, path: str, table: str, columns=None) -> DataFrame:
    """Header CSV -> typed columns (by name). ``columns`` limits the projection."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    types = FEED_TYPES.get(table, {})
    cols = columns or raw.columns
    return raw.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in cols])


def write_feed_csv(df: DataFrame, path: str) -> None:
    """Write a feed table as header CSV (doubles keep their shortest exact text form)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_json_documents(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Files that each hold one JSON document (an object or an array of records)."""
    r = spark.read.option("multiLine", True).option("recursiveFileLookup", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_json_lines(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Lines of a name, a tab and a JSON document (an array of records, or one): ``name`` and the fields of each record."""
    parts = F.split("value", "\t", 2)
    named = spark.read.text(path).select(parts[0].alias("name"), F.trim(parts[1]).alias("doc"))
    array = F.when(F.col("doc").startswith("["), F.col("doc")).otherwise(F.concat(F.lit("["), "doc", F.lit("]")))
    return named.select("name", F.inline(F.from_json(array, T.ArrayType(T.StructType.fromDDL(record)))))


# ------------------------------------------------------------------ S3: feed archive members
# A feed arrives as one archive or, when it is large, as several part archives, each holding a stretch of
# one or more members. Archives are read as (path, content) by Spark, from whatever store it reaches, so each
# file is one row of one task; its members are unpacked there and leave as Arrow batches.

PART_ROWS = 100_000     # rows of a member in one part archive
BLOCK = 1 << 20         # bytes of CSV that one Arrow batch comes from


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the zip files at ``path`` (a file, a folder or a comma-separated list)."""
    return spark.read.format("binaryFile").load(path.split(",")).select("path", "content")


def pack_member(df: DataFrame, member: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(path, content): the rows of ``df`` as part archives, each with ``<member>.txt``, a CSV with a header. Every task packs its own rows."""
    columns = df.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.csv as pc

        part, held, n = TaskContext.get().partitionId(), [], 0

        def archive(tables: list, k: int) -> pa.RecordBatch:
            raw, out = io.BytesIO(), io.BytesIO()
            pc.write_csv(pa.Table.from_batches(tables), raw)
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(f"{member}.txt", raw.getvalue())
            return pa.RecordBatch.from_pydict({"path": [f"{member}-{part:05d}-{k:05d}.zip"], "content": pa.array([out.getvalue()], pa.binary())})

        k = 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= part_rows:
                yield archive(held, k)
                held, n, k = [], 0, k + 1
        if n:
            yield archive(held, k)

    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return text.mapInArrow(pack, "path string, content binary")


def _members(content: bytes) -> tuple[zipfile.ZipFile, dict[str, str]]:
    z = zipfile.ZipFile(io.BytesIO(content))
    return z, {n.rsplit("/", 1)[-1].removesuffix(".txt"): n for n in z.namelist() if n.endswith(".txt")}


def feed_rows(packed: DataFrame, member: str, columns) -> DataFrame:
    """The rows of one member in all archives; ``columns`` are read by name (a column that a part lacks is null) and typed."""
    columns = list(columns)
    schema = pa.schema([(c, pa.string()) for c in columns])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.csv as pc

        for b in batches:
            for content in b.column("content"):
                z, names = _members(content.as_py())
                if member not in names:
                    continue
                with z.open(names[member]) as f:
                    first = f.readline()
                if not first.strip():
                    continue
                with z.open(names[member]) as f:
                    rows = pc.open_csv(f, pc.ReadOptions(block_size=max(BLOCK, 2 * len(first))), pc.ParseOptions(newlines_in_values=True),
                                       pc.ConvertOptions(column_types=schema, include_columns=columns, include_missing_columns=True,
                                                         strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=False))
                    for batch in rows:
                        yield batch

    types = FEED_TYPES.get(member, {})
    rows = packed.select("content").mapInArrow(unpack, ", ".join(f"`{c}` string" for c in columns))
    return rows.select(*[F.col(f"`{c}`").cast(types.get(c, "string")).alias(c) for c in columns])


def absent_members(packed: DataFrame) -> DataFrame:
    """S3 report mode: the required members that no archive holds."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = sorted({n for content in b.column("content") for n in _members(content.as_py())[1]})
            yield pa.RecordBatch.from_pydict({"member": pa.array(found, pa.string())})

    spark = packed.sparkSession
    required = spark.createDataFrame([(m,) for m in REQUIRED_MEMBERS], "member string")
    return required.join(packed.select("content").mapInArrow(names, "member string").distinct(), "member", "left_anti")


def missing_members(spark: SparkSession, path: str) -> DataFrame:
    return absent_members(archives(spark, path))


def feed_zip_table(spark: SparkSession, path: str, table: str, columns, on_missing: str = "fail") -> DataFrame:
    """One member of the feed archive(s) at ``path`` as a typed table; fails, or not, if the feed lacks a required member."""
    packed = archives(spark, path)
    if on_missing == "fail":
        absent = [r.member for r in absent_members(packed).collect()]      # REQUIRED_MEMBERS at most
        if absent:
            raise FileNotFoundError(f"{path}: missing feed members {absent}")
    return feed_rows(packed, table, columns)
