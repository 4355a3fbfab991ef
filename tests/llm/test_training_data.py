"""Training-data operators against brute-force versions, and on nulls, empties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tools.oracle_check import compare
from waka.llm import (common, decontamination, fingerprints, language_id, licenses, mixing, ngram_join, secrets, sharding,
                      token_count, toxicity)

SF = "/root/testdata/sf0.001"
TYPES = "doc_id long, text string, lang string, source string, n_chars long, shard string, copies string, licenses string"
LOWER = str.maketrans(common.UPPER, common.LOWER)


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(spark):
    return {r["doc_id"]: r["text"] for r in docs(spark).collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and repeated rows, one long text, columns that clash with results."""
    long = "under the MIT license " * 3000
    rows = [(1, None, None, None, None, "x", "y", "z"), (2, "", "en", "a", 0, "x", "y", "z"), (None, "one two", "en", "a", 7, "x", "y", "z"),
            (3, long, "en", "b", 1, "x", "y", "z"), (3, long, "en", "b", 1, "x", "y", "z"), (4, " \t\n", "fr", None, 3, "x", "y", "z"),
            (None, None, None, None, None, None, None, None), (5, "é Ünïcode ﬁ 漢字 token = \"0a1b2c3d4e5f60718293\"", "fr", "a", 9, "x", "y", "z")]
    return spark.createDataFrame(rows, TYPES)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def sets(spark):
    out = {}
    for d, x in texts(spark).items():
        w = re.findall(r"[^\x20\x09-\x0D]+", x.translate(LOWER))
        out[d] = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def groups(s):
    root = {d: d for d in s}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(d for d in s if s[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(s[a] & s[b])
            if 100 * both >= 80 * (len(s[a]) + len(s[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in s}


# sharding

@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one_to_one_and_inverts(n):
    p = sharding.permute(np.arange(n), n, 5)
    assert sorted(p) == list(range(n))
    assert (sharding.permute(p, n, 5, back=True) == np.arange(n)).all()
    assert n < 97 or (p != sharding.permute(np.arange(n), n, 6)).any()


def test_shards_are_even_gapless_and_computable(spark):
    got = sharding.op1_sharding(spark, SF).toPandas()
    sizes = got.groupby("shard").size()
    assert len(got) == 200 and set(got["shard"]) == set(range(24)) and sizes.max() - sizes.min() <= 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))
    ids = sorted(got["doc_id"])
    assert all(ids[sharding.row_at(r.shard, r.slot, 200, 24, 20)] == r.doc_id for r in got.itertuples())
    again = sharding.shard_rows(docs(spark).select("doc_id").repartition(7), F.col("doc_id"), n_shards=24).toPandas()
    assert dict(zip(again["doc_id"], again["shard"], strict=True)) == dict(zip(got["doc_id"], got["shard"], strict=True))


def test_sharding_odd_rows(odd, none):
    got = sharding.shard_rows(odd, F.col("doc_id"), n_shards=3).toPandas()
    assert len(got) == 8 and sorted(got.groupby("shard").size()) == [2, 3, 3]
    assert sharding.shard_rows(none, F.col("doc_id"), n_shards=3).count() == 0


# decontamination

def test_leaks_equal_all_windows(spark):
    cut = re.compile(decontamination.PATTERN)

    def runs(x):
        w = cut.findall(x.translate(LOWER))
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []

    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    pool = dict(list(texts(spark).items())[:120])
    rng = random.Random(3)
    for k, (i, t) in enumerate(list(items.items())):      # edited copies: some words replaced, put in or left out
        w = t.split()
        for _ in range(k % 4):
            at = rng.randrange(len(w))
            w[at:at + 1] = [["other"], [w[at], "more"], []][rng.randrange(3)]
        pool[1000 + k] = f"Before it stands this. {' '.join(w)} And after it that, and more words than one."
    want = {}
    for d, x in pool.items():
        s = runs(x)
        for i, t in items.items():
            item = runs(t)
            width, have = min(len(item), len(s)), collections.Counter(item)
            if s and set(item) & set(s):
                best = max(m / (len(item) + width - m) for a in range(len(s) - width + 1)
                           for m in [sum((have & collections.Counter(s[a:a + width])).values())])
                if best >= 0.8 - 1e-12:
                    want[d, i] = best
    frame = spark.createDataFrame(list(pool.items()), "doc_id long, text string")
    got = decontamination.find_leaks(frame, spark.createDataFrame(list(items.items()), "item_id long, text string")).toPandas()
    have = {(r.doc_id, r.item_id): r.similarity for r in got.itertuples()}
    assert len(want) > 15 and have.keys() == want.keys() and all(abs(have[k] - want[k]) < 1e-9 for k in want)
    assert got["distance"].max() <= decontamination.RADIUS


def test_leaks_odd_rows(spark, odd, none):
    item = spark.createDataFrame([(1, "the mit license under the mit license"), (2, None), (None, "")], "item_id long, text string")
    assert {r["doc_id"] for r in decontamination.find_leaks(odd, item).collect()} == {3}
    assert decontamination.find_leaks(none, item).count() == 0 and decontamination.find_leaks(odd, item.limit(0)).count() == 0


# language identification

def test_language_held_out(spark):
    got = language_id.op3_language_id(spark, "/root/testdata/sf0.01").toPandas().merge(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert len(held) > 150 and (held["lang"] == held["lang_pred"]).mean() > 0.98 and got["score"].between(0, 1).all()


def test_codewords_keep_apart():
    for n in (2, 4, 5, 12):
        c = language_id.codewords(n)
        assert len(c) == n and min((c[i] != c[j]).sum() for i in range(n) for j in range(i)) >= (1 if n == 2 else 4)


def test_language_odd_rows(odd, none):
    model = language_id.train(odd)
    got = language_id.identify(odd, model, ["doc_id", "text"]).toPandas()
    assert (got[got["text"].isna() | (got["text"].fillna("").str.strip() == "")]["lang_pred"] == "und").all()
    assert language_id.identify(none, model, ["doc_id"]).count() == 0
    assert set(language_id.identify(odd, language_id.train(none), ["doc_id"]).toPandas()["lang_pred"]) == {"und"}


# licenses

def test_license_labels(spark, odd, none):
    t = [(1, "Licensed under the Apache License, Version 2.0"), (2, "CC BY-NC CC BY-NC 4.0"), (3, "under the mitt license"),
         (4, "Permission is hereby granted, free of charge, to any person obtaining one copy of this software")]
    got = {r["doc_id"]: [(p["label"], p["base"], p["at"]) for p in r["licenses"]] for r in licenses.scan(
        spark.createDataFrame(t, "doc_id long, text string")).collect()}
    assert got == {1: [("apache-2", True, 3)], 2: [("cc-by-nc", True, 0), ("cc-by-nc", True, 3)], 3: [], 4: [("mit", False, 0)]}
    rows = {(r["doc_id"], r["n_words"], len(r["licenses"])) for r in licenses.scan(odd).collect()}
    assert (3, 12000, 3000) in rows and (1, 0, 0) in rows and (2, 0, 0) in rows
    assert licenses.scan(none).count() == 0


def test_license_places_equal_brute_force(spark):
    """Phrases whole, broken, shifted, repeated, with other words for some of theirs, and rare words out of place."""
    rng = random.Random(12)
    templates = [*licenses.BASE, *licenses.MORE]
    filler = ["the", "license", "mit", "version", "gnu", "public", "by", "cc", "of", "software", "lorem", "ipsum"]
    pool = []
    for k in range(160):
        w: list[str] = []
        for _ in range(rng.randint(1, 4)):
            t = list(rng.choice(templates).words)
            for _ in range(rng.choice([0, 0, 1, len(t) // 8])):
                t[rng.randrange(len(t))] = rng.choice(filler)
            cut = rng.choice([0, 0, 1, 2])
            w += [rng.choice(filler) for _ in range(rng.randint(0, 5))] + t[cut:]
        pool.append((k, " ".join(w)))
    want = {}
    for k, text in pool:
        w = text.split()
        want[k] = collections.Counter()
        for t in templates:
            for at in range(-len(t.words), len(w)):
                same = [0 <= at + j < len(w) and w[at + j] == x for j, x in enumerate(t.words)]
                if all(same[slice(*t.key)]) and sum(same) / len(same) >= licenses.COVERAGE:
                    want[k][t.label, t.base, at, round(sum(same) / len(same), 9)] += 1
    got = {r["doc_id"]: collections.Counter((p["label"], p["base"], p["at"], round(p["coverage"], 9)) for p in r["licenses"])
           for r in licenses.scan(spark.createDataFrame(pool, "doc_id long, text string")).collect()}
    assert got == want and sum(sum(c.values()) for c in want.values()) > 150


def test_license_identifiers_and_whole_texts(spark):
    whole = max((t for t in licenses.MORE if t.label == "mit"), key=lambda t: len(t.words))
    t = [(1, "GNU Affero General Public License, version 3"), (2, "SPDX-License-Identifier: Apache-2.0"), (3, "Creative Commons Attribution 4.0"),
         (4, "terms of the MIT License"), (5, " ".join(whole.words).capitalize() + ".")]
    got = {r["doc_id"]: {p["label"] for p in r["licenses"]} for r in licenses.scan(spark.createDataFrame(t, "doc_id long, text string")).collect()}
    assert got == {1: {"agpl-3"}, 2: {"apache-2"}, 3: {"cc-by"}, 4: {"mit"}, 5: {"mit"}}


# toxicity

def slow_kernel(s, t):
    import itertools
    total = 0.0
    for a in itertools.combinations(range(len(s)), toxicity.SUB):
        for b in itertools.combinations(range(len(t)), toxicity.SUB):
            if all(s[i] == t[j] for i, j in zip(a, b, strict=True)):
                total += toxicity.DECAY ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_equals_brute_force():
    a, b = ["idiot", "clowns", "abc", "xyzzy"], ["idxiot", "crown", "cba", "xyz"]
    got = toxicity.raw_kernel(toxicity._grid(a), toxicity._grid(b))
    assert np.allclose(got, [slow_kernel(*p) for p in zip(a, b, strict=True)])


@pytest.fixture(scope="module")
def judge(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abdeghklnprstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(vocabulary) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            w[rng.randrange(30)] = rng.choice(["idiot", "moron", "clowny"])
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame([*labels, (None, None, None), (3, None, None)], "doc_id long, quality int, toxic int")
    return d, lab, toxicity.train(d, lab)


def test_toxicity_held_out_and_gaps(spark, judge, odd, none):
    d, lab, model = judge
    got = toxicity.score_documents(d, model, ["doc_id"]).toPandas().merge(lab.dropna().toPandas(), on="doc_id")
    held = got[[toxicity_bucket(i) == 1 for i in got["doc_id"]]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.97
    gaps = spark.createDataFrame([(1, "kel an i d i o t lunt"), (2, "kel an id-iot. lunt"), (3, "kel an lunt"), (4, "IDIOT!")], "doc_id long, text string")
    said = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(gaps, model, ["doc_id"]).collect()}
    assert said == {1: 1, 2: 1, 3: 0, 4: 1}
    assert set(toxicity.score_documents(odd, model, ["doc_id", "text", "shard"]).toPandas()["predicted"]) == {0}
    assert toxicity.score_documents(none, toxicity.train(none, lab.limit(0)), ["doc_id"]).count() == 0


def toxicity_bucket(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 3


# secrets

def test_secrets(spark, odd, none):
    rows = [(i, f"lorem token = \"{hashlib.md5(str(i).encode()).hexdigest()}\" ipsum card {10 ** 15 + i * 7919} dolor", "src") for i in range(60)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    assert len(got) == 120 and (got["secret"] == (got["finding"].str.len() == 32)).all()
    assert secrets.scan(odd).toPandas()["finding"].tolist() == ["0a1b2c3d4e5f60718293"] and secrets.scan(none).count() == 0


# mixing

def test_mix_meets_targets(spark, odd, none):
    got = mixing.op7_mixing(spark, SF).toPandas().merge(docs(spark).select("doc_id", "source").toPandas(), on="doc_id")
    assert abs(got.groupby("source")["target"].first().sum() - got["size"].sum()) < 1e-6
    for _, g in got.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= g["size"].max() / 2 + 1e-6
    assert (got["taken"] <= 3 * got["size"]).all()
    mixed = mixing.mix(odd, mixing.n_words(F.col("text")), F.lit(None).cast("double")).toPandas()
    assert len(mixed) == 8 and mixed["size"].sum() == 24000 + 2 + 7 and (mixed["taken"] == mixed["copies"] * mixed["size"]).all()
    assert mixing.mix(none, mixing.n_words(F.col("text")), F.lit(1.0)).count() == 0


# token counts

def test_token_counts(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path(token_count.VOCABULARY))
    rng = random.Random(4)
    letters = [chr(i) for i in range(1, 300)] + ["<|endoftext|>", "'s", "  ", "漢", "😀", "é", "​", "'LL"]
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["a" * 5000, " " * 700]
    got = token_count.count_tokens(spark.createDataFrame(list(enumerate(pool)), "doc_id long, text string")).collect()
    assert len(got) == len(pool)
    for r in got:
        assert r["n_tokens"] == len(lib.encode(pool[r["doc_id"]], add_special_tokens=False)) and r["n_bytes"] == len(pool[r["doc_id"]].encode())
    assert token_count.count_tokens(odd).count() == 8 and token_count.count_tokens(none).count() == 0


# n-gram join

def test_join_equals_brute_force(spark):
    s = sets(spark)
    want = groups(s)
    got = ngram_join.op9_ngram_join(spark, SF).toPandas()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in got.itertuples()} == {d: (want[d], len(s[d])) for d in s}


def test_join_large_near_group_and_chain(spark):
    """Near copies around several bases, chains whose ends do not link, copies, and a passage that all share."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(20)]
    pool = []
    for _ in range(6):
        base = [word() for _ in range(60)] + passage
        for k in range(25):
            w = list(base)
            for _ in range(k % 4):
                w[rng.randrange(len(w))] = word()
            pool.append(w)
        w = list(base)
        for _ in range(8):      # a chain that drifts away
            w = w[1:] + [word()]
            w[rng.randrange(len(w))] = word()
            pool.append(list(w))
    pool += [list(pool[0])] * 5 + [passage, ["a", "b"], ["a", "b"], ["c"]]
    rng.shuffle(pool)
    s = {i: frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) for i, w in enumerate(pool)}
    want = groups(s)
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(pool)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_groups(frame).collect()}
    assert got == want and len(set(want.values())) > 5


def test_join_outsiders_link_members(spark, monkeypatch):
    """Texts too far from the hub of a large group that repeat the edits of some of its members."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))

    def edited(w, times):
        w = list(w)
        for _ in range(times):
            w[rng.randrange(len(w))] = word()
        return w

    pool = []
    for _ in range(3):
        base = [word() for _ in range(140)]
        near = [edited(base, 1 + k % 3) for k in range(60)]
        pool += [base, *near, *[edited(near[k], 1 + k % 3) for k in range(0, 60, 2)], *[edited(base, 4 + k % 3) for k in range(30)]]
    rng.shuffle(pool)
    s = {i: frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) for i, w in enumerate(pool)}
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(pool)], "doc_id long, text string")
    found = []
    member_links = ngram_join._member_links
    monkeypatch.setattr(ngram_join, "_member_links", lambda *a: found.extend(got := member_links(*a)) or got)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_groups(frame).collect()}
    assert got == groups(s)
    assert sum(e.count() for e in found) > 0


def test_join_odd_rows(odd, none):
    got = ngram_join.similar_groups(odd).toPandas()
    assert len(got) == 8 and (got[got["n_shingles"] == 0]["component_id"].fillna(-1) == got[got["n_shingles"] == 0]["doc_id"].fillna(-1)).all()
    assert got[got["doc_id"] == 3]["component_id"].tolist() == [3, 3] and ngram_join.similar_groups(none).count() == 0


# fingerprints

def test_fingerprints(spark):
    t = texts(spark)
    ids = sorted(t, reverse=True)
    got = fingerprints.op10_fingerprints(spark, SF).toPandas().set_index("doc_id")
    s = sets(spark)
    for k, d in enumerate(ids):
        x, n = t[d], t[ids[(k + 1) % len(ids)]]
        half = len(x) // 2
        assert got["edited_sha256"][d] == hashlib.sha256((x[:len(x) - half] + n[:half]).encode()).hexdigest()
        both = len(s[d] & s[ids[(k + 1) % len(ids)]])
        exact = both / (len(s[d]) + len(s[ids[(k + 1) % len(ids)]]) - both)
        assert abs(got["near_next"][d] - exact) < 0.3
        assert len(s[d]) >= fingerprints.K or got["est_shingles"][d] == len(s[d])
    by_text = collections.defaultdict(set)
    for d in ids:
        by_text[t[d]].add(got["fingerprint"][d])
    assert all(len(v) == 1 for v in by_text.values())


def test_sketches_merge(spark):
    one = spark.createDataFrame([(1, "a b c d e f g h i j " * 3 + " ".join(map(str, range(300))))], "doc_id long, text string")
    parts = [" ".join(map(str, range(0, 204))), " ".join(map(str, range(200, 300))), "a b c d e f g h i j " * 3 + "0 1 2 3"]
    part = spark.createDataFrame([(7, p) for p in parts] + [(8, "")], "g long, text string").select("g", fingerprints.sketch(F.col("text")).alias("sketch"))
    merged = {r["g"]: r["sketch"] for r in fingerprints.merge_parts(part, "g").collect()}
    whole = one.select(fingerprints.sketch(F.col("text")).alias("s")).first()["s"]
    assert merged[8] == [] and len(set(merged[7]) & set(whole)) >= len(whole) - 2


def test_next_rows_odd(odd, none):
    got = fingerprints.with_next(odd.select("doc_id", "text"), ["text"]).toPandas()
    assert len(got) == 8 and got[got["doc_id"] == 5]["next_text"].tolist() == [" \t\n"]
    assert fingerprints.with_next(none.select("doc_id", "text"), ["text"]).count() == 0
    many = odd.sparkSession.range(4000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    pairs = fingerprints.with_next(many, ["text"]).toPandas()
    assert ((pairs["doc_id"] - 1) % 4000 == pairs["next_text"].astype(int)).all()


# SQL and pipeline

@pytest.mark.parametrize("key", ["op4_license_scan", "op7_mixing"])
def test_sql_agrees(spark, duck, key):
    ok, message = compare(entry.queries()[key](spark, SF).toPandas(), duck(SF).execute(entry.oracle_sql()[key]).df())
    assert ok, message


def test_pipeline_stages(spark):
    frame, seen = docs(spark), []
    for name, stage in corpus_pipeline.STAGES:
        frame = common.materialize(stage(spark, frame, SF), f"test-{name}")
        seen.append(frame.toPandas())
    clean, single, free, mixed, shards = seen
    assert all(list(x.columns) == docs(spark).columns for x in seen[:-1])
    s = {d: x for d, x in sets(spark).items() if d in set(clean["doc_id"])}
    want = groups(s)
    assert sorted(single["doc_id"]) == sorted(d for d in s if want[d] == d)
    leaks = decontamination.find_leaks(docs(spark), spark.read.parquet(f"{SF}/benchmark.parquet")).toPandas()
    assert sorted(free["doc_id"]) == sorted(set(single["doc_id"]) - set(leaks["doc_id"]))
    words = lambda x: x["text"].map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    total = words(free).sum()
    assert abs(words(mixed).sum() - total) <= sum(words(g).max() / 2 for _, g in free.groupby("source")) + 1
    assert mixed.groupby("doc_id").size().max() <= 3 and set(mixed["doc_id"]) <= set(free["doc_id"])
    assert sorted(shards["doc_id"]) == sorted(mixed["doc_id"]) and shards.groupby("shard").size().max() - shards.groupby("shard").size().min() <= 1
