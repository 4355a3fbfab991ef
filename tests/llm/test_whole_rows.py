"""Ids, extra columns and hot keys: what goes in comes out, whatever the operators do between."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waka import session
from waka.llm import common, fingerprints, language_id, mixing, ngram_join, token_count, toxicity
from waka.llm.language_id import bucket

SF = "/root/testdata/sf0.001"
BIG = [9007199254740993, 9007199254740995, None, (1 << 62) + 1]


@pytest.fixture(scope="module")
def clashing(spark):
    """Long ids beside a null, and columns with the names of results, of working columns, and with a dot."""
    rows = [(i, f"some plain text number {k} of the house and the garden", "en", "s", 9, "v", "w", "x", "y", 7, "z", "k") for k, i in enumerate(BIG * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, score string, value string, "
                                        "copies string, taken long, `a.b` string, __key string")
    return frame


def test_ids_stay_whole(spark, clashing):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = sorted(map(str, BIG * 3))
    model = toxicity.train(clashing, labels)
    ids = lambda frame, c="doc_id": sorted(str(r[c]) for r in frame.select(c).collect())
    assert ids(toxicity.score_documents(clashing, model, ["doc_id"])) == want
    assert ids(language_id.identify(clashing, language_id.train(clashing), ["doc_id"])) == want
    assert ids(token_count.count_tokens(clashing)) == want
    joined = ngram_join.similar_groups(clashing)
    assert ids(joined) == want and set(ids(joined, "component_id")) <= set(want)


def test_stages_keep_every_column(spark, clashing):
    none = clashing.limit(0)
    whole = lambda frame: collections.Counter(tuple(r) for r in frame.collect())
    have = whole(clashing)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, SF)
        assert out.columns == clashing.columns, name
        got = whole(out)
        assert set(got) <= set(have) and (name == "mixing" or got <= have), name
        assert stage(spark, none, SF).count() == 0, name
    last = corpus_pipeline.STAGES[-1][1](spark, clashing, SF)
    assert last.columns == [*clashing.columns, "shard", "slot"]
    assert whole(last.drop("shard", "slot")) == have


def test_near_copies_keep_one_row_of_a_group(spark, clashing):
    copies = clashing.unionByName(clashing.withColumn("lang", F.lit("de")))
    got = corpus_pipeline.stage_near_copies(spark, copies, SF).toPandas()
    known = got[got["doc_id"].notna()]        # the numbers keep the texts apart: each has one copy
    assert len(known) == 9 and known["text"].is_unique and (got["doc_id"].isna()).sum() == 6


@pytest.mark.parametrize("kind", ["one id", "one row"])
def test_mix_of_a_hot_key(spark, kind):
    """A key with all but a few rows of a source: its targets are met, whole rows are repeated, and no task forms one long sum."""
    n = 6000
    hot = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"),
                                (F.lit("w w w") if kind == "one row" else F.concat(F.lit("w w "), F.col("id").cast("string"))).alias("text"))
    rest = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "b").otherwise("c").alias("source"), F.lit("x " * 40).alias("text"))
    docs = hot.unionByName(rest).repartition(6)
    size = mixing.n_words(F.col("text"))
    mixed = mixing.mix(docs, size, F.lit(1.0)).toPandas()
    taken = mixing.taken_rows(docs, size, F.lit(1.0)).toPandas()
    assert list(taken.columns) == docs.columns
    for source, g in mixed.groupby("source"):
        target = g["target"].iloc[0]
        assert abs(g["taken"].sum() - target) <= g["size"].max() / 2 + 1e-6
        again = taken[taken["source"] == source]["text"].map(lambda t: len(t.split())).sum()
        assert abs(again - target) <= g["size"].max() / 2 + 1e-6
    assert (mixed["taken"] <= 3 * mixed["size"]).all()
    sized = common.materialize(mixing.keyed(docs, size, F.lit(1.0)).select("source", "doc_id", "__size", "__key", "__tie"), "test-sized")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixing.walk(sized)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    order = [p for p in session._SCRATCH if "/mix-order-" in p][-1]
    parts = spark.read.parquet(order).groupBy(F.shiftright("__place", 33)).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < n / 4


def test_mix_and_taken_rows_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    weighed, weight = mixing.label_weight(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    size = mixing.n_words(F.col("text"))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(weighed, size, weight).collect()}
    got = collections.Counter(r["doc_id"] for r in mixing.taken_rows(weighed, size, weight).select("doc_id").collect())
    assert got == collections.Counter({d: c for d, c in copies.items() if c})


def test_language_equals_slow_decoding(spark):
    """Every judged text against a decoder that goes trigram by trigram and language by language."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs.where(bucket(F.col("doc_id"), 4) != 2))
    got = {r["doc_id"]: r for r in language_id.op3_language_id(spark, SF).collect()}
    for r in docs.limit(40).collect():
        text = r["text"]
        if not text or not any(c.isalpha() for c in text):
            assert got[r["doc_id"]]["lang_pred"] == "und"
            continue
        data = [b if b >= 128 or 97 <= b <= 122 else 32 for b in f"  {text.lower()} ".encode()]
        total, n = np.zeros(model.code.shape[1]), 0
        for a, b, c in zip(data, data[1:], data[2:]):
            if (a, b, c) != (32, 32, 32):
                total += model.weights[(((a << 16 | b << 8 | c) * 2654435761) % (1 << 32)) >> 19]
                n += 1
        loss = {}
        for lang, word in zip(model.languages, model.code, strict=True):
            loss[lang] = sum(w * math.log1p(math.exp(-bit * m * language_id.SCALE)) for bit, m, w in zip(word, total / n, model.bit_weight, strict=True)) * len(word)
        p = {x: math.exp(-v) for x, v in loss.items()}
        best = max(p, key=p.get)
        assert got[r["doc_id"]]["lang_pred"] == best and abs(got[r["doc_id"]]["score"] - p[best] / sum(p.values())) < 1e-3


def test_fingerprints_of_edited_texts(spark):
    """Every column of the fingerprints recomputed from the texts alone."""
    import re

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.op10_fingerprints(spark, SF).collect()}
    lower = str.maketrans(common.UPPER, common.LOWER)

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(lower))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    cut = lambda f: [f[i:i + 16] for i in range(0, len(f), 16)]
    signed = lambda h: int(h, 16) - (1 << 64 if int(h, 16) >> 63 else 0)

    def likeness(a, b):
        a, b = sorted(map(signed, cut(a))), sorted(map(signed, cut(b)))
        union = sorted({*a, *b})[:fingerprints.K]
        return 1.0 if not union else len(set(a) & set(b) & set(union)) / len(union)

    for k, d in enumerate(ids):
        own, after = docs[d] or "", docs[ids[(k + 1) % len(ids)]] or ""
        half = len(own) // 2
        edited = own[:len(own) - half] + after[:half]
        r = got[d]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(own)
        assert abs(r["near_edited"] - likeness(r["fingerprint"], r["edited_fingerprint"])) < 1e-9
        assert abs(r["near_next"] - likeness(r["fingerprint"], got[ids[(k + 1) % len(ids)]]["fingerprint"])) < 1e-9
        for f, text in ((r["fingerprint"], own), (r["edited_fingerprint"], edited)):
            assert len(cut(f)) == min(fingerprints.K, len(shingles(text)))
        inside = shingles(edited)
        part = len(inside & shingles(own)) / len(inside) if inside else 1.0
        assert abs(r["est_containment"] - part) < 0.35


def test_random_byte_counts_are_not_split(spark):
    """Broadcast bounds are measured in bytes: few rows with much in them are not small."""
    rng = random.Random(1)
    wide = common.materialize(spark.createDataFrame([(i, ["x" * 50_000 for _ in range(10)], rng.random()) for i in range(40)],
                                                    "id int, v array<string>, r double"), "test-wide")
    assert not common.is_small(wide) and common.is_small(wide.limit(3)) and common.is_small(wide.select("id", "r"))
