"""Document fingerprints (10): bottom-k sketches of shingle hashes.

A sketch is the sorted array of the k smallest distinct 64-bit shingle hashes of a text. The
sketch of a union is the k smallest of both sketches together, so parts can be sketched apart and merged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waka.llm.common import ascii_lower, let, read, shingles, words

K = 64
BUCKET_ROWS = 1500     # documents that one window sorts together, about
_SIDE = 100            # bucket bounds are looked up in two steps of at most so many


def sketch(text: Column, k: int = K) -> Column:
    """Bottom-k sketch of the five-word shingles of a text (A-Z lower-cased); empty or null: empty."""
    return F.slice(F.sort_array(F.array_distinct(shingles(words(ascii_lower(text))))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched shingle sets."""
    return F.slice(F.sort_array(F.array_distinct(F.concat(a, b))), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both sketches hold. Two empty sets: 1."""
    share = let(merge(a, b, k), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    reach = (F.get(a, F.lit(k - 1)).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: resemblance times the union's size over a's. An empty a: 1."""
    part = resemblance(a, b, k) * let(merge(a, b, k), lambda u: distinct_shingles(u, k)) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), part))


def merge_parts(parts: DataFrame, by: str, column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per value of ``by`` from any number of part sketches. Hashes are cut to the k smallest of
    each of 64 slices of a group first, so that no task gathers a large group."""
    one = parts.select(by, F.explode(column).alias("__h")).distinct().withColumn("__slice", F.pmod("__h", F.lit(64)))
    for keys in ([by, "__slice"], [by]):
        one = one.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy("__h"))).where(
            F.col("__rank") <= k)
    merged = one.groupBy(by).agg(F.sort_array(F.collect_list("__h")).alias(column))
    return (parts.select(by).distinct().withColumnRenamed(by, "__by")
            .join(merged, F.col("__by").eqNullSafe(F.col(by)), "left")
            .select(F.col("__by").alias(by), F.coalesce(column, F.array().cast("array<bigint>")).alias(column)))


def as_text(s: Column) -> Column:
    """A sketch as a string: 16 hex digits for each hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _bounds(docs: DataFrame, order: str) -> list[int]:
    """Ids that cut the table into stretches of about BUCKET_ROWS rows, at most _SIDE ** 2."""
    n = docs.count()
    parts = max(1, min(_SIDE ** 2, math.ceil(n / BUCKET_ROWS)))
    cuts = docs.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)] or [0.5], 100_000)).first()[0]
    return sorted(set(cuts or [])) if parts > 1 else []


def _bucket(x: Column, bounds: list[int]) -> Column:
    """How many bounds are below x (null: -1)."""
    if not bounds:
        return F.when(x.isNull(), -1).otherwise(0)
    rows = [bounds[i:i + _SIDE] for i in range(0, len(bounds), _SIDE)]
    below = lambda a: F.size(F.filter(a, lambda b: b < x))
    longs = lambda v: F.array(*[F.lit(b).cast("long") for b in v])
    row = below(longs([r[-1] for r in rows]))
    return F.when(x.isNull(), -1).otherwise(
        row * _SIDE + F.coalesce(below(F.get(F.array(*[longs(r) for r in rows]), row)), F.lit(0)))


def with_next(docs: DataFrame, columns: list[str], order: str = "doc_id") -> DataFrame:
    """``docs`` with ``next_<column>`` of the following row in descending ``order``; after the last comes the first.

    Rows are cut into stretches of ids, each sorted by one task; the first row of a stretch is also sent to
    the end of the stretch before it. Null ids come last; rows of one id are ordered by a hash of their columns.
    """
    own = [c for c in docs.columns if c not in {f"next_{c}" for c in columns}]
    tagged = docs.select(*[F.col(f"`{c}`") for c in own], F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("__h"))
    keyed = tagged.withColumn("__bucket", _bucket(F.col(order), _bounds(docs, order)))
    heads = keyed.groupBy("__bucket").agg(F.max(F.struct(order, "__h")).alias("__head"))
    every = Window.orderBy(F.desc("__bucket"))      # one row per stretch: at most _SIDE ** 2 + 1
    first = F.first("__bucket").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.last("__bucket").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select(F.col("__bucket").alias("__of"), "__head",
                         F.when(F.col("__bucket") == first, last).otherwise(F.lag("__bucket").over(every)).alias("__to"))
    here = F.struct(F.col("__bucket").alias("bucket"), F.lit(0).alias("ghost"))
    there = F.struct(F.col("__to").cast("int").alias("bucket"), F.lit(1).alias("ghost"))
    sent = (keyed.join(F.broadcast(heads), (F.col("__bucket") == F.col("__of"))
                       & F.struct(F.col(order), F.col("__h")).eqNullSafe(F.col("__head")), "left")
            .withColumn("__place", F.explode(F.when(F.col("__to").isNull(), F.array(here)).otherwise(F.array(here, there)))))
    w = Window.partitionBy("__place.bucket").orderBy("__place.ghost", F.desc_nulls_last(order), F.desc("__h"))
    return (sent.select(*[F.col(f"`{c}`") for c in own], "__place", "__h")
            .withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
            .where(F.col("__place.ghost") == 0).drop("__place", "__h"))


def fingerprint_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text and ``sketch`` of every document; null and empty texts have an empty sketch."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("sketch", sketch(F.col("text"), k))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fingerprint_documents(read(spark, sf_dir, "documents"))
    n = F.col("n_chars")
    half = F.floor(n / 2).cast("int")
    both = (with_next(docs, ["text", "sketch"])
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), (n - half).cast("int")),
                                           F.substring(F.col("next_text"), F.lit(1), half)))
            .withColumn("edited_sketch", sketch(F.col("edited"))))
    return both.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).cast("double").alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).cast("double").alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("est_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("est_containment"))
