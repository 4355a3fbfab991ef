"""Substring dedup (12): recompression of the texts' word sequences.

Each round gives a name to every run of one symbol and to every pair of a left and a right symbol (a bit of the name says which
it is); names are hashes of what they stand for, so all tasks name alike. Whether two symbols are joined depends on
these two alone: the rounds keep, for each symbol, the stretch of words that settles it, and inside equal passages all symbols
settled by the passage are the same. Every window of WINDOW words thus picks the same one of its settled symbols (of the highest
round that has any, the longest) wherever it stands. Windows that pick one symbol in one place form a stretch.

Spark counts the symbols: one that is picked in a single place makes no window repeat; one whose stretches are all the same makes all
of theirs repeat. Only where the stretches of a symbol differ (the ends of repeats) are windows verified one by one, by 128-bit hashes
of their words, from one copy of each different stretch. What is passed on are the places that occur once, so no count is joined back to a hot key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import materialize, read, small

WINDOW = 35
ROUNDS = 3
CHUNK = 500_000        # words that numpy works on at once
CACHED = 1_000_000     # words whose hashes a worker keeps

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)       # odd
_ALL = (1 << 64) - 1
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_ROW: dict[str, int] = {}
_HASHES: list[np.ndarray] = [np.zeros((2, 1 << 12), dtype=np.uint64)]      # grows by doubling


def word_hashes(words: list[str]) -> np.ndarray:
    """Two 64-bit hashes of each word; a worker hashes a word once."""
    from waka.llm import repeats as here      # the worker's own module, which outlives a task

    row = here._ROW
    if len(row) > CACHED:
        row.clear()
    new = [w for w in set(words) if w not in row]
    if new:
        old, end = len(row), len(row) + len(new)
        while here._HASHES[0].shape[1] < end:
            here._HASHES[:] = [np.hstack([here._HASHES[0], np.zeros_like(here._HASHES[0])])]
        whole = b"".join(xxhash.xxh3_128_digest(w.encode("utf-8", "surrogatepass")) for w in new)
        here._HASHES[0][:, old:end] = np.frombuffer(whole, dtype=">u8").reshape(-1, 2).T
        row.update(zip(new, range(old, end), strict=True))
    return here._HASHES[0][:, np.fromiter(map(row.__getitem__, words), dtype=np.int64, count=len(words))]


class Hashes:
    """Hashes of any stretch of a word sequence, from prefix sums of its words' hashes times powers of a base (modulo 2 ** 64)."""

    def __init__(self, words: np.ndarray, which: int = 0):
        base, n = _BASE[which], words.shape[1]
        self.power = np.cumprod(np.concatenate([[U(1)], np.full(n, U(base))]), dtype=np.uint64)
        back = np.cumprod(np.concatenate([[U(1)], np.full(n, U(pow(base, -1, 1 << 64)))]), dtype=np.uint64)
        self.sums = np.concatenate([[U(0)], np.cumsum(words[which] * back[:n], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.power[start] + (end - start).astype(np.uint64))


class Symbols:
    """The symbols of some texts in a row after a number of rounds: name, words [start, end), and [left, right), the words that settle it.
    An edge of a text settles nothing: left or right is then beyond the text."""

    def __init__(self, names: np.ndarray, offsets: np.ndarray):
        n = len(names)
        self.offsets, self.name = offsets, names
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.start, self.end = np.arange(n), np.arange(1, n + 1)
        self.left, self.right = self.start, self.end

    def next(self, round_no: int) -> Symbols:
        """One round: runs are named, then pairs of neighbouring runs."""
        name, text, n = self.name, self.text, len(self.name)
        same_text = text[1:] == text[:-1]
        run = np.flatnonzero(np.concatenate([[True], ~(same_text & (name[1:] == name[:-1]))]))
        length = np.diff(np.append(run, n)).astype(np.uint64)
        symbol = name[run]
        named = np.where(length > U(1), mix(symbol + mix(length + U(0x5DEECE66D))), symbol)
        is_right = (mix(symbol + U(0xA0761D6478BD642F * (round_no + 1) & _ALL)) >> U(63)).astype(bool)
        joined = np.concatenate([[False], ~is_right[:-1] & is_right[1:] & (text[run][1:] == text[run][:-1])])
        first = np.flatnonzero(~joined)
        second = np.minimum(first + 1, len(run) - 1)
        paired = np.append(joined, False)[first + 1]
        out = Symbols.__new__(Symbols)
        out.offsets = self.offsets
        out.name = np.where(paired, mix(named[first] * U(0xE7037ED1A0B428DB) + mix(named[second])), named[first])
        a = run[first]
        z = np.append(a[1:], n) - 1
        out.text, out.start, out.end = text[a], self.start[a], self.end[z]
        lo, hi = self.offsets[out.text], self.offsets[out.text + 1]
        out.left = np.where(out.start == lo, lo - 1, self.left[np.maximum(a - 1, 0)])
        out.right = np.where(out.end == hi, hi + 1, self.right[np.minimum(z + 1, n - 1)])
        return out


def pick(levels: list[Symbols], words: Hashes, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start: the key of the symbol that the window picks, and the symbol's place (start and round). The key stands for
    the symbol with all words that settle it, for a window holds these too."""
    key, place = np.zeros(len(at), dtype=np.uint64), np.zeros(len(at), dtype=np.int64)
    todo = np.arange(len(at))
    for k in range(len(levels) - 1, -1, -1):
        s = levels[k]
        worth = (np.minimum(s.end - s.start, 63).astype(np.uint64) << U(58)) | (s.name >> U(6))
        a, b = np.searchsorted(s.left, at[todo], "left"), np.searchsorted(s.right, at[todo] + window, "right")
        best, open_, step = a.copy(), np.flatnonzero(b - a > 1), 1
        while open_.size:
            j = a[open_] + step
            better = worth[j] > worth[best[open_]]
            best[open_[better]] = j[better]
            step += 1
            open_ = open_[b[open_] - a[open_] > step]
        some = a < b
        j = best[some]
        key[todo[some]] = mix(s.name[j] + words.of(s.left[j], s.right[j]) + U(k))
        place[todo[some]] = s.start[j] * 16 + k
        todo = todo[~some]
        if not todo.size:
            break
    return key, place


def stretches(texts: list[list[str]], window: int = WINDOW, rounds: int = ROUNDS) -> list[tuple[np.ndarray, ...]]:
    """For each text (of at least ``window`` words) its stretches of windows: key, hash of their words, first window, number of windows."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    hashes = word_hashes([w for t in texts for w in t])
    levels = [Symbols(hashes[0], offsets)]
    for k in range(rounds):
        levels.append(levels[-1].next(k))
    n_windows = size - window + 1
    of_text = np.repeat(np.arange(len(texts)), n_windows)
    at = np.arange(len(of_text)) + (offsets[:-1] - np.concatenate([[0], np.cumsum(n_windows)[:-1]]))[of_text]
    whole = Hashes(hashes)
    key, place = pick(levels, whole, at, window)
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (of_text[1:] != of_text[:-1])]))
    count = np.diff(np.append(first, len(at)))
    words = whole.of(at[first], at[first] + count + window - 1)
    owner = of_text[first]
    cuts = np.searchsorted(owner, np.arange(1, len(texts)))
    parts = [np.split(x, cuts) for x in (key[first].view(np.int64), words.view(np.int64), at[first] - offsets[owner], count)]
    return list(zip(*parts, strict=True))


def covered_words(n_words: int, uncovered: list, window: int = WINDOW) -> np.ndarray:
    """Which words some repeated window covers, from the spans (first, number) of window starts that don't repeat."""
    repeated = np.ones(n_words - window + 1, dtype=np.int64)
    for first, n in uncovered:
        repeated[first:first + n] = 0
    edge = np.zeros(n_words + 1, dtype=np.int64)
    edge[:len(repeated)] += repeated
    edge[window:] -= repeated
    return np.cumsum(edge)[:-1] > 0


def _sha(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()


def parse(text: Column, window: int) -> Column:
    """struct of n_words, sha256 of all words, and the arrays of the text's stretches."""

    @F.pandas_udf("n_words long, whole binary, key array<long>, words array<long>, first array<int>, n array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list = []
            wait: list[tuple[int, list[str]]] = []

            def flush() -> None:
                for (i, _), found in zip(wait, stretches([t for _, t in wait], window) if wait else [], strict=True):
                    rows[i][2:] = found[0], found[1], found[2].astype(np.int32), found[3].astype(np.int32)
                wait.clear()

            waiting = 0
            for text in b:
                words = _WORD.findall(text) if text else []
                none = np.zeros(0, dtype=np.int64)
                rows.append([len(words), bytes.fromhex(_sha(words)), none, none, none.astype(np.int32), none.astype(np.int32)])
                if len(words) >= window:
                    wait.append((len(rows) - 1, words))
                    waiting += len(words)
                    if waiting >= CHUNK:
                        flush()
                        waiting = 0
            flush()
            yield pd.DataFrame(rows, columns=["n_words", "whole", "key", "words", "first", "n"])

    return of(text)


def window_hashes(text: Column, spans: Column, window: int) -> Column:
    """For each window of the spans (first, n, weight): its two hashes, start and weight."""

    @F.pandas_udf("h array<long>, g array<long>, at array<int>, weight array<int>")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, wanted in batches:
            rows = []
            for text, span in zip(texts, wanted, strict=True):
                hashes = word_hashes(_WORD.findall(text))
                at = np.concatenate([np.arange(s["first"], s["first"] + s["n"]) for s in span])
                weight = np.repeat([s["weight"] for s in span], [s["n"] for s in span])
                h, g = (Hashes(hashes, k).of(at, at + window).view(np.int64) for k in (0, 1))
                rows.append((h, g, at.astype(np.int32), weight.astype(np.int32)))
            yield pd.DataFrame(rows, columns=["h", "g", "at", "weight"])

    return of(text, spans)


SPANS = "array<struct<first:int,n:int>>"


def kept_words(text: Column, uncovered: Column, window: int) -> Column:
    """struct of the removed spans of words (first, n) and the sha256 of the others, joined by one space."""

    @F.pandas_udf(f"removed {SPANS}, kept_sha256 string")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, gaps in batches:
            rows = []
            for text, gap in zip(texts, gaps, strict=True):
                words = _WORD.findall(text)
                gone = covered_words(len(words), [(s["first"], s["n"]) for s in gap], window)
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).tolist()
                spans = [{"first": a, "n": b - a} for a, b in zip(edge[::2], edge[1::2], strict=True)]
                rows.append((spans, _sha([w for w, x in zip(words, gone.tolist(), strict=True) if not x])))
            yield pd.DataFrame(rows, columns=["removed", "kept_sha256"])

    return of(text, uncovered)


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (stored, one row for each t1, t2) with the text of these hashes; of equal texts one travels from each task."""
    hashed = docs.where(F.col("text").isNotNull()).select(*text_key(), "text")
    keys = wanted.select("t1", "t2").distinct()
    few = small(keys)
    if few is not keys:        # marked for broadcast: only the wanted texts are shuffled
        hashed = hashed.join(few, ["t1", "t2"], "left_semi")
    return hashed.groupBy("t1", "t2").agg(F.first("text").alias("text")).join(wanted, ["t1", "t2"])


def text_key() -> list[Column]:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(12), "text").alias("t2")]


def once(stretch: DataFrame, docs: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """row, first and n of the windows that occur in one place only. ``stretch``: row, key, words, first, n."""
    keys = materialize(stretch.groupBy("key").agg(
        F.count(F.lit(1)).alias("places"), F.min("words").alias("lo"), F.max("words").alias("hi"),
        F.max("row").alias("row"), F.max("first").alias("first"), F.max("n").alias("n")), "repeats-keys")
    alone = keys.where(F.col("places") == 1).select("row", "first", "n")
    # stretches of a symbol that differ: one place of each, whose windows weigh 2 if there are more
    open_keys = small(materialize(keys.where(F.col("lo") != F.col("hi")).select("key"), "repeats-open"))
    spans = (stretch.join(open_keys, "key", "left_semi").groupBy("key", "words")
             .agg(F.max(F.struct("row", "first", "n")).alias("p"), F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("weight"))
             .groupBy("p.row").agg(F.collect_list(F.struct("p.first", "p.n", "weight")).alias("spans")))     # spans of one text
    wanted = materialize(spans.join(rows.select("row", "t1", "t2"), "row"), "repeats-spans")
    got = texts_of(docs, wanted).select("row", window_hashes(F.col("text"), F.col("spans"), window).alias("w"))
    each = got.select("row", F.explode(F.arrays_zip("w.h", "w.g", "w.at", "w.weight")).alias("x"))
    singles = (each.groupBy("x.h", "x.g").agg(F.sum("x.weight").alias("weight"), F.max("row").alias("row"), F.max("x.at").alias("first"))
               .where(F.col("weight") == 1).select("row", "first", F.lit(1).alias("n")))
    return alone.unionByName(singles)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and ``removed``, the spans of words (first, n) that go, of every row, from columns doc_id and text.

    A word goes if a window of ``window`` consecutive words covers it whose words also start anywhere else, in the same text or another.
    Null and empty texts have no words; texts shorter than the window lose nothing, nor make others lose; repeated rows repeat each other;
    null ids are kept; other columns are dropped; an empty table gives an empty result.
    """
    parsed = docs.select("doc_id", *text_key(), parse(F.col("text"), window).alias("p"))
    rows = materialize(parsed.select("doc_id", "t1", "t2", "p.*", F.monotonically_increasing_id().alias("row")), "repeats-parsed")
    long = rows.where(F.col("n_words") >= window)
    stretch = (long.select("row", F.explode(F.arrays_zip("key", "words", "first", "n")).alias("s")).select("row", "s.*"))
    gaps = once(stretch, docs, rows, window).groupBy("row").agg(
        F.sum("n").alias("n_once"), F.collect_list(F.struct("first", "n")).alias("gaps"))      # windows of one text
    state = materialize(long.select("row", "doc_id", "t1", "t2", "n_words", "whole").join(gaps, "row", "left").select(
        "doc_id", "t1", "t2", "n_words", "whole", F.coalesce("n_once", F.lit(0)).alias("n_once"), "gaps"), "repeats-state")
    n_windows = F.col("n_words") - window + 1
    none = rows.where(F.col("n_words") < window).select("doc_id", "n_words", "whole").unionByName(
        state.where(F.col("n_once") == n_windows).select("doc_id", "n_words", "whole"))
    none = none.select("doc_id", "n_words", F.array().cast(SPANS).alias("removed"), F.lower(F.hex("whole")).alias("kept_sha256"))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("n"))).cast(SPANS)
    emptied = state.where(F.col("n_once") == 0).select("doc_id", "n_words", whole.alias("removed"), F.sha2(F.lit(""), 256).alias("kept_sha256"))
    # texts with windows that occur once stand in one row each
    part = state.where((F.col("n_once") > 0) & (F.col("n_once") < n_windows)).select("doc_id", "t1", "t2", "n_words", "gaps")
    cut = texts_of(docs, part).select("doc_id", "n_words", kept_words(F.col("text"), F.col("gaps"), window).alias("k")).select("doc_id", "n_words", "k.*")
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    return none.unionByName(emptied).unionByName(cut).select("doc_id", "n_words", n_removed.alias("n_removed"), "kept_sha256", "removed")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("removed")


ORACLE = rf"""
WITH d AS (SELECT *, row_number() OVER () AS rn, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rn, s, list_aggregate(w[s:s + {WINDOW - 1}], 'string_agg', ' ') AS run FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS u(s)),
rep AS (SELECT rn, s FROM (SELECT *, count(*) OVER (PARTITION BY run) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT rn, i FROM rep, unnest(range(s, s + {WINDOW})) AS u(i)),
per AS (SELECT rn, list(i) AS gone FROM gone GROUP BY rn)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(list_aggregate(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), 'string_agg', ' '), '')) AS kept_sha256
FROM d LEFT JOIN per USING (rn)
"""
