"""A corpus pipeline of the training-data operators: each stage reads what the one before it wrote.

toxicity (rejected documents go), n-gram Jaccard join (one row of each linked group stays), benchmark
decontamination (documents with a benchmark item go), mixing (documents as often as the mix takes them),
sharding (shuffled order). The join decides by doc_id and text: different texts that share a doc_id are kept or dropped
each by their own links.

All stages: rows with a null id or text stay unless a rule says otherwise, equal rows are judged alike, texts of any length are
read whole, an empty table stays empty, and every column of the input, whatever its name, comes out as it went in (the last
stage adds shard and slot, replacing columns of these names). Only the text is handed to Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm import decontamination, mixing, ngram_join, sharding, toxicity
from waka.llm.common import read, small
from waka.session import drop_scratch, materialize, prepare, scratch_mark


def packed(docs: DataFrame) -> DataFrame:
    """``__row``, the whole row as one struct, with ``__id`` and ``__hash`` (of the text) beside it."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("__row")).select("__row", F.col("__row.doc_id").alias("__id"), F.xxhash64("__row.text").alias("__hash"))


def _these(keys: DataFrame) -> tuple[DataFrame, Column]:
    """Stored ids and text hashes, and the condition that a packed row is one of them."""
    keys = small(keys.select(F.col("doc_id").alias("__key_id"), F.col("text_hash").alias("__key_hash")))
    return keys, F.col("__id").eqNullSafe(F.col("__key_id")) & (F.col("__hash") == F.col("__key_hash"))


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not reject. It is trained on the labelled documents among those given; without any, all stay."""
    prepare(spark)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(model, F.col("text")) < toxicity.THRESHOLD)


def stage_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts, that of the smallest (doc_id, text hash), of such rows the one of least hash; texts without words and
    rows with a null id all stay."""
    prepare(spark)
    groups = materialize(ngram_join.text_groups(docs).where(F.col("group").isNotNull() & F.col("doc_id").isNotNull()), "pipeline-groups")
    texts = groups.groupBy("group", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = groups.groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    marked = materialize(texts.join(first, "group").select(
        "doc_id", "text_hash", "n", (F.struct("doc_id", "text_hash") == F.col("first")).alias("stays")), "pipeline-texts")
    gone, is_gone = _these(materialize(marked.where(~F.col("stays")).select("doc_id", "text_hash"), "pipeline-gone"))
    kept = packed(docs).join(gone, is_gone, "left_anti")
    twice = materialize(marked.where(F.col("stays") & (F.col("n") > 1)).select("doc_id", "text_hash"), "pipeline-twice")
    if not twice.isEmpty():
        twice, is_twice = _these(twice)
        one = (kept.join(twice, is_twice, "left_semi").groupBy("__id", "__hash").agg(F.min_by("__row", F.xxhash64("__row")).alias("__row")))
        kept = kept.join(twice, is_twice, "left_anti").select("__row").unionByName(one.select("__row"))
    return kept.select("__row.*")


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    leaks = decontamination.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    leaked, is_leaked = _these(materialize(leaks.select("doc_id", "text_hash").distinct(), "pipeline-leaks"))
    return packed(docs).join(leaked, is_leaked, "left_anti").select("__row.*")


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    row = packed(docs).select("__row", F.col("__id").alias("doc_id"), F.col("__row.source").alias("source"))
    weighed, weight = mixing.label_weight(row, read(spark, sf_dir, "labels"))
    taken = mixing.taken_rows(weighed, mixing.n_words(F.col("__row.text")), weight)
    return taken.select("__row.*")


def stage_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot in the shuffled order."""
    return sharding.shard_rows(docs, F.col("doc_id"), n_shards=24)


STAGES = [
    ("toxicity", stage_toxicity),
    ("near_copies", stage_near_copies),
    ("decontamination", stage_decontamination),
    ("mixing", stage_mixing),
    ("sharding", stage_sharding),
]

#: The trained model and the reachability over links are not expressible in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage stored for itself is deleted once its result is stored."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        mark = scratch_mark()
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_scratch(spark, mark, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
