"""Mixing sources to target weights (7): Efraimidis-Spirakis sampling.

Each document gets the key -ln(u) / w, u a uniform number from its id and w its quality
weight; in key order within a source, documents are taken until the source's word budget is met.
Whole epochs come first, the fraction that remains is the start of the key order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waka.llm.common import WORD, materialize, read, small

WEIGHTS = (5, 2, 1)     # of the sources by code point, repeating
MAX_EPOCHS = 3
SEED = "mix-1"


def uniform(doc_id: Column, seed: str) -> Column:
    """In (0, 1): the first 52 bits of md5(id # seed)."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("#" + seed)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_plan(sized: DataFrame) -> DataFrame:
    """One row per source: size, rows, target. Targets share the total by weight and stop at
    MAX_EPOCHS times the source's size, the excess going to the others by weight: in ascending order of
    cap / weight, a source is capped when its share of what the sources before it leave reaches its cap."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    per = (per.withColumn("rank", F.row_number().over(by_name) - 1)
           .withColumn("weight", F.get(cycle, F.pmod("rank", F.lit(len(WEIGHTS)))))
           .withColumn("cap", F.col("source_size") * float(MAX_EPOCHS)))
    tight = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("total", F.sum("source_size").over(every))
           .withColumn("w_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("c_left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("level", F.col("c_left") / F.col("w_left"))
           .withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap")))
    # the level of the first source that is not capped holds for all of those
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(every)
    return per.select("source", "rank", "source_size", "n_rows", F.when(F.col("capped"), F.col("cap")).otherwise(
        free["level"] * F.col("weight")).alias("target"))


def keyed(docs: DataFrame, size: Column, weight: Column, seed: str = SEED) -> DataFrame:
    """``docs`` with ``__size``, ``__key`` and ``__tie``, a hash of the whole row: the order in which a source's rows are taken is (key, doc_id, size, tie)."""
    w = F.when(weight > 0, weight).otherwise(F.lit(1.0)).cast("double")
    return docs.withColumns({"__size": F.coalesce(size.cast("long"), F.lit(0).cast("long")),
                             "__key": -F.log(uniform(F.col("doc_id"), seed)) / w,
                             "__tie": F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])})


def walk(sized: DataFrame) -> DataFrame:
    """Of stored rows with source, doc_id, __size, __key and __tie: the rows with source_size, target, ``epochs`` (times every row of the source is
    taken) and ``extra`` (1 for the rows at the start of the source's order that are taken once more).

    All rows are range-partitioned and sorted by source and order, so a hot source, id or key is cut like any other stretch, and equal rows by
    their place; a row's prefix sum is that of its partition's rows before it and of the partitions before.
    """
    plan = source_plan(sized.select("source", F.col("__size").alias("size"))).withColumnsRenamed({"source": "__name", "rank": "__src"})
    own = (sized.join(small(materialize(plan, "mix-plan")), F.col("source").eqNullSafe(F.col("__name"))).drop("__name", "n_rows")
           .withColumn("__scan", F.monotonically_increasing_id()))
    order = [F.col(c) for c in ("__src", "__key", "doc_id", "__size", "__tie", "__scan")]
    stored = materialize(own.repartitionByRange(*order).sortWithinPartitions(*order).drop("__scan")
                         .withColumn("__place", F.monotonically_increasing_id()), "mix-order")
    stored = stored.withColumn("__part", F.shiftright("__place", 33))
    sums = stored.groupBy("__src", "__part").agg(F.sum("__size").alias("__sum"))
    ahead = Window.partitionBy("__src").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)      # one row per source and partition
    sums = sums.select(F.col("__src").alias("__s"), F.col("__part").alias("__p"), F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__ahead"))
    within = Window.partitionBy("__src", "__part").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__ahead") + F.coalesce(F.sum("__size").over(within), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("int")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    return (stored.join(small(materialize(sums, "mix-sums")), (F.col("__src") == F.col("__s")) & (F.col("__part") == F.col("__p")))
            .withColumn("__start", start).withColumn("epochs", epochs)
            .withColumn("extra", F.when((rest > 0) & (2 * F.col("__start") + F.col("__size") <= 2 * rest), 1).otherwise(0))
            .drop("__s", "__p", "__ahead", "__start", "__src", "__part", "__place"))


def mix(docs: DataFrame, size: Column, weight: Column, seed: str = SEED) -> DataFrame:
    """``docs`` (with doc_id and source) plus size, source_size, target, ``copies`` (times the mix takes
    the document) and ``taken`` (words).

    A source's taken words miss its target by at most half a document. Documents of size 0 are taken
    with no words. Null sources form one source, sorted last; null ids share one key; rows of one key are ordered by a hash of the
    row, and equal rows trade places only with each other; a weight that is null or not positive counts as 1. An empty table gives an empty
    result. Clashing columns (size, source_size, target, copies, taken) are replaced.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    row = F.struct(*[F.col(f"`{c}`") for c in own])
    sized = keyed(docs, size, weight, seed).select("source", "doc_id", "__size", "__key", "__tie", row.alias("__row"))
    got = walk(materialize(sized, "mix-sized"))
    copies = F.col("epochs") + F.col("extra")
    return got.select("__row.*", F.col("__size").alias("size"), "source_size", "target", copies.alias("copies"),
                      (copies * F.col("__size")).alias("taken"))


def taken_rows(docs: DataFrame, size: Column, weight: Column, seed: str = SEED) -> DataFrame:
    """``docs``, each row as often as the mix takes it, none of its columns changed.

    The rows of a source that are taken once more are those up to one place in its order. That place is found on narrow rows
    without the text, and every row is then judged by itself, so no text is shuffled. Rows equal to the one at that
    place can only be told from it by their number: as many of them stay as the mix takes.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = keyed(docs, size, weight, seed).select("source", "doc_id", "__size", "__key", "__tie", row.alias("__row"))
    at = F.struct("__key", "doc_id", "__size", "__tie")
    mixed = materialize(walk(materialize(rows.drop("__row"), "mix-sized")).select("source", at.alias("at"), "epochs", "extra"), "mix-walked")
    per = mixed.groupBy("source").agg(F.max("epochs").alias("epochs"), F.max(F.when(F.col("extra") == 1, F.col("at"))).alias("last"))
    per = materialize(per.withColumnRenamed("source", "__name"), "mix-last")
    here = F.col("source").eqNullSafe(F.col("__name"))
    equal = (mixed.select("source", "at", "extra").join(small(per), here & (F.col("at") == F.col("last"))).groupBy("__name", "epochs", "last")
             .agg(F.sum("extra").alias("held"), F.count(F.lit(1)).alias("met")))
    split = materialize(equal.where(F.col("held") < F.col("met")).select(F.col("__name").alias("__cut"), "held", "met"), "mix-split")
    judged = rows.select("source", "__row", at.alias("at")).join(small(per), here)
    copies = F.col("epochs") + F.when(F.col("at") <= F.col("last"), 1).otherwise(0)
    repeat = lambda n: F.explode(F.sequence(F.lit(1), n.cast("int")))
    if split.isEmpty():
        return judged.withColumn("n", copies).where(F.col("n") > 0).select("__row", repeat(F.col("n"))).select("__row.*")
    judged = judged.join(small(split), F.col("source").eqNullSafe(F.col("__cut")), "left")
    on_cut = F.col("held").isNotNull() & (F.col("at") == F.col("last"))
    plain = judged.where(~F.coalesce(on_cut, F.lit(False))).withColumn("n", copies)
    cut = (judged.where(on_cut).groupBy("__name").agg(F.first("__row").alias("__row"), F.max("epochs").alias("epochs"),
                                                     F.max("held").alias("held"), F.max("met").alias("met"))
           .withColumn("n", F.col("epochs") * F.col("met") + F.col("held")))
    both = plain.select("__row", "n").unionByName(cut.select("__row", "n"))
    return both.where(F.col("n") > 0).select("__row", repeat(F.col("n"))).select("__row.*")


def quality_weight(quality: Column) -> Column:
    """Documents labelled good draw twice as strongly as those labelled poor; unlabelled ones lie between."""
    return F.when(quality == 1, 2.0).when(quality == 0, 1.0).otherwise(1.5)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def label_weight(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Column]:
    """``docs`` beside a column that holds each row's weight (by the best label of its id; null ids have none)."""
    best = labels.groupBy(F.col("doc_id").alias("__label_id")).agg(F.max("quality").alias("__quality"))
    return docs.join(small(materialize(best, "mix-labels")), F.col("doc_id") == F.col("__label_id"), "left"), quality_weight(F.col("__quality"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("__n"))
    docs, weight = label_weight(docs, read(spark, sf_dir, "labels"))
    return mix(docs, F.col("__n"), weight).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = rf"""
WITH lab AS (SELECT doc_id, max(quality) quality FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source,
         coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || '#{SEED}'), 1, 13))::BIGINT::DOUBLE + 0.5) / {float(1 << 52)!r}::DOUBLE)
           / CASE WHEN l.quality = 1 THEN 2.0::DOUBLE WHEN l.quality = 0 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS k
  FROM documents d LEFT JOIN lab l ON d.doc_id = l.doc_id),
per AS (SELECT source, sum(size)::BIGINT source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk, 3.0::DOUBLE * source_size AS cap FROM per),
weighed AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER p, 0)) /
            (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS lev
  FROM weighed WINDOW p AS (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (
  SELECT source, source_size, CASE WHEN lev * w >= cap THEN cap ELSE
    (SELECT lev FROM levels WHERE lev * w < cap ORDER BY cap / w, rk LIMIT 1) * w END AS target FROM levels),
walk AS (
  SELECT s.doc_id, s.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size) ELSE 1 END AS epochs,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
done AS (
  SELECT *, (epochs + CASE WHEN target - epochs * source_size > 0
                            AND 2 * ahead + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END)::INT AS copies
  FROM walk)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies FROM done
"""
