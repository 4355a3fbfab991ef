"""Spelling variants (11), substring dedup (12) and the Merkle manifest (13) against brute force and on odd tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.oracle_check import compare
from waka.llm import manifest, repeats, spelling

SF = "/root/testdata/sf0.001"
TYPES = "doc_id long, text string, lang string, source string, n_chars long, word string, n string, tree string, level string, row string"
CLASH = ("x",) * 5


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, langs and texts, empty and repeated rows, one long text, ids above 2 ** 53 beside a null, columns that clash with results."""
    long = "alpha beta gamma delta " * 4000
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "one two", "en", "a", 7), (3, long, "en", "b", 1), (3, long, "en", "b", 1),
            (4, " \t\n", "fr", None, 3), (None, None, None, None, None), (9007199254740993, "é Ünïcode ﬁ 漢字", "fr", "a", 9),
            (9007199254740995, "ABC ünïcode", "Zz", "a", 9)]
    return spark.createDataFrame([(*r, *CLASH) for r in rows], TYPES)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.mark.parametrize("key", ["op1_sharding", "op9_ngram_join", "op11_spelling_variants", "op12_substring_dedup", "op13_merkle_manifest"])
def test_sql_agrees(spark, duck, key):
    ok, message = compare(entry.queries()[key](spark, SF).toPandas(), duck(SF).execute(entry.oracle_sql()[key]).df())
    assert ok, message


#: Queries without SQL, and the tests that hold them against a slow version, the library or held-out labels.
STAND_INS = {
    "op2_decontamination": "test_leaks_equal_all_windows", "op3_language_id": "test_language_equals_slow_decoding",
    "op5_toxicity": "test_toxicity_held_out_and_gaps", "op6_secret_scan": "test_secrets", "op8_token_count": "test_token_counts",
    "op10_fingerprints": "test_fingerprints_of_edited_texts", "pipeline": "test_pipeline_stages",
}


def test_queries_without_sql_have_a_test():
    from waka.plans.catalog import QUERIES

    defined = "".join(p.read_text() for p in Path(__file__).parent.glob("test_*.py"))

    without = {k for k in entry.queries() if k not in entry.oracle_sql() and k not in QUERIES}
    assert without == set(STAND_INS)
    assert [t for t in STAND_INS.values() if f"\ndef {t}(" not in defined] == []


# spelling

def near(a, b):
    letters = "abcdefghijklmnopqrstuvwxyzéà"
    if a == b:
        return False
    edits = {a[:i] + a[i + 1:] for i in range(len(a))} | {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in letters}
    return b in edits | {a[:i] + c + a[i + 1:] for i in range(len(a)) for c in letters}


def slow_groups(counts):
    out = {}
    for w, n in counts.items():
        others = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form = others[0][1] if others and -others[0][0] >= spelling.RATIO * n else None
        out[w] = [form, None, n, len(others), counts.get(form)]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return out


@pytest.mark.parametrize("part,visits", [(4096, 1 << 16), (7, 9)])
def test_spelling_groups_equal_brute_force(spark, monkeypatch, part, visits):
    monkeypatch.setattr(spelling, "PART", part)
    monkeypatch.setattr(spelling, "VISITS", visits)
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9))) for _ in range(40)]
    counts = {}
    for w in base:
        n = rng.choice([5, 40, 300, 2000])
        counts[w] = n
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(w))
            v = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abà") + w[at:], w[:at] + rng.choice("abz") + w[at + 1:], w[::-1]])
            counts.setdefault(v, max(1, n // rng.choice([1, 5, 6, 30])))
    counts["a" * 5000], counts["a" * 5001] = 9, 90
    frame = spark.createDataFrame([*counts.items(), (None, 7)], "word string, n long").withColumn("root", F.lit("clash"))
    got = {r["word"]: [r["form"], r["root"], r["n"], r["n_near"], r["form_n"]] for r in spelling.spelling_groups(frame).collect()}
    short = {w: n for w, n in counts.items() if len(w) < 100}
    want = slow_groups(short) | {"a" * 5000: ["a" * 5001, "a" * 5001, 9, 1, 90], "a" * 5001: [None, "a" * 5001, 90, 1, None]}
    assert got == want and len({tuple(v) for v in got.values()}) > 30


def test_one_edit_is_exact():
    words = ["".join(w) for n in range(5) for w in itertools.product("ab", repeat=n)]
    assert all(spelling.one_edit(a, b) == near(a, b) for a in words for b in words)


def test_search_meets_every_word_within_the_budget():
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abcd"), rng.integers(1, 7))) for _ in range(400)})
    grid = spelling.vectors(words)
    order = np.lexsort(grid.T[::-1])
    got = {(int(i), int(order[j])) for who, row in spelling.search(grid[order], grid) for i, j in zip(who, row, strict=True)}
    d = grid[None, :, :] - grid[:, None, :]
    fits = (np.maximum(d, 0).sum(2) <= 1) & (np.maximum(-d, 0).sum(2) <= 1)
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(fits), strict=True)}


def test_words_lose_letters_by_their_hash(spark, odd, none):
    rows = [(i, "Spelling VARIANT überall naïveté tiny " * 3) for i in range(300)]
    want: collections.Counter = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{i}:{run}".encode())
            want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 7 == 0 else run] += 1
    got = {r["word"]: r["n"] for r in spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string"), every=7).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5} and len(got) > 8
    assert spelling.count_words(odd, min_length=4).count() == 4 and spelling.count_words(none).count() == 0
    assert spelling.spelling_groups(spelling.count_words(none)).count() == 0


# repeats

def slow_repeats(texts, window):
    starts = collections.Counter(tuple(t[i:i + window]) for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = {j for i in range(len(t) - window + 1) if starts[tuple(t[i:i + window])] > 1 for j in range(i, i + window)}
        kept = [w for j, w in enumerate(t) if j not in gone]
        out.append((len(t), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("broadcast", [16 << 20, 0])
def test_repeats_equal_brute_force(spark, monkeypatch, broadcast):
    from waka.llm import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast)
    rng = random.Random(5)
    texts = []
    for vocabulary in (2, 5, 400):
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(250)]
        for _ in range(25):
            t: list[str] = []
            for _ in range(rng.randint(1, 5)):
                at = rng.randrange(200)
                t += rng.choice([base[at:at + rng.randint(1, 80)], [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(0, 50))],
                                 ["a"] * rng.randint(1, 90), ["a", "b", "c"] * rng.randint(1, 30), [f"u{rng.random()}" for _ in range(40)]])
            texts.append(t)
    texts += [list(texts[0]), list(texts[1]), list(texts[1]), [], ["x"] * 8, ["x"] * 9, ["x"] * 10]
    window = 9
    frame = spark.createDataFrame([(i, "  ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = repeats.remove_repeats(frame, window).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found}
    assert [got[i] for i in range(len(texts))] == slow_repeats(texts, window)
    for r in found:      # the spans say the same
        gone = {j for s in r["removed"] for j in range(s["first"], s["first"] + s["n"])}
        kept = " ".join(w for j, w in enumerate(texts[r["doc_id"]]) if j not in gone)
        assert len(gone) == r["n_removed"] and hashlib.sha256(kept.encode()).hexdigest() == r["kept_sha256"]
    assert {0 < r[1] < r[0] for r in got.values()} == {True, False}


def test_every_window_picks_its_symbol_wherever_it_stands():
    rng = random.Random(6)
    passage = [f"p{rng.randrange(6)}" for _ in range(120)]
    texts = [[f"u{rng.randrange(9)}" for _ in range(rng.randrange(50))] + passage + [f"v{rng.randrange(9)}" for _ in range(rng.randrange(50))] for _ in range(40)]
    seen = collections.defaultdict(set)
    for t, (key, _, first, n) in zip(texts, repeats.stretches(texts), strict=True):
        for k, f, m in zip(key.tolist(), first.tolist(), n.tolist(), strict=True):
            for i in range(f, f + m):
                seen[tuple(t[i:i + repeats.WINDOW])].add(k)
    assert all(len(keys) == 1 for keys in seen.values()) and len(seen) > 1000


def test_repeats_odd_rows(odd, none):
    got = repeats.remove_repeats(odd).toPandas()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(zip(got["n_words"], got["n_removed"], strict=True)) == [(0, 0)] * 4 + [(2, 0)] * 2 + [(4, 0)] + [(16000, 16000)] * 2
    assert (got["kept_sha256"][(got["n_words"] == 0) | (got["n_removed"] > 0)] == empty).all()
    ids = {r["doc_id"] for r in repeats.remove_repeats(odd).select("doc_id").collect()}
    assert ids == {1, 2, 3, 4, None, 9007199254740993, 9007199254740995}
    assert repeats.remove_repeats(none).count() == 0


# manifest

def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_tree(nodes):
    """The root and, for each leaf, the siblings before and after it on its way up."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, joined = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a:a + 8]
            for j in range(len(run)):
                for i in groups[a + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(H("".join(run)))
            joined.append([i for g in groups[a:a + 8] for i in g])
        nodes, groups = up, joined
    return nodes[0], paths


def slow_manifest(rows):
    def leaf(r, low=False):
        text = r["text"]
        if low and text is not None:
            text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    trees = collections.defaultdict(list)
    for r in rows:
        trees[r["lang"]].append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    low = {x: sorted(trees[x], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for x in langs}
    made = {x: slow_tree([leaf(r) for r in low[x]]) for x in langs}
    root, tops = slow_tree([made[x][0] for x in langs])
    out = []
    for x, top in zip(langs, tops, strict=True):
        for r, path in zip(low[x], made[x][1], strict=True):
            fold = leaf(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0)
            proof = ""
            for before, after in path + top:
                fold, proof = H(before + fold + after), proof + before + after
            out.append((r["doc_id"], leaf(r), made[x][0], root, H(proof), fold, fold == root))
    return out


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 65, 8, 3, 1, 1, 20, 2, 7, 1], [70]])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(9)
    rows = []
    for k, n in enumerate(sizes):
        for _ in range(n):
            rows.append((rng.choice([None, rng.randrange(1 << 60)]) if k % 3 == 1 else len(rows), rng.choice(["Ab c", "ÄB", "", None]),
                         None if k == 3 else f"l{k}", rng.choice(["s", None]), rng.choice([0, None, -4])))
    rows += rows[:2]      # equal rows are leaves of their own
    frame = spark.createDataFrame([(*r, *CLASH) for r in rows], TYPES)
    got = [tuple(r) for r in manifest.prove(frame.repartition(3)).collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(slow_manifest([r.asDict() for r in frame.collect()]), key=key)


def test_manifest_odd_rows(spark, odd, none):
    got = [tuple(r) for r in manifest.prove(odd).collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(slow_manifest([r.asDict() for r in odd.collect()]), key=key)
    empty = manifest.prove(none)
    assert empty.count() == 0 and empty.columns == manifest.prove(odd).columns
    assert spark.conf.get(manifest.ROW_LIMIT) != "-1"
