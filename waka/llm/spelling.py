"""Spelling variant grouping (11): a frequency-vector trie searched with a budget.

A word's vector counts its letters by group; the trie branches on the count of one group after the other.
One inserted, deleted or replaced letter changes the vector by at most one surplus and one deficit, so a depth-first search that may
spend one of each meets every word one edit away, and the words at its leaves are verified letter by letter.

The words are sorted along the trie and cut into parts of PART words, each a stretch of the trie. The same search, over the
parts' first vectors alone, finds the parts that a word must visit; Spark deals the visits, and each task builds the trie of
one part at a time and lets the visiting words search it a batch at a time.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import CRC_TABLE, LOWER, UPPER, crc_sql, materialize, number_rows, read, small

EVERY = 199            # of the hashed (document, run) pairs, one in so many loses a letter
MIN_LENGTH, MIN_COUNT = 6, 5
RATIO = 5              # how much commoner a word's form must be
GROUPS = 32            # of letters, by the last bits of their code points: each of a-z is its own
PART = 4096            # words of a part
VISITS = 16 * PART     # visits to a part that one task takes; a part with more is searched by several tasks
LEAF = 8               # words of a trie node that are compared at once
FLUSH = 200_000        # words that a task counts before it hands them on

_LOWER = str.maketrans(UPPER, LOWER)


@cache
def runs_of(min_length: int) -> re.Pattern:
    """Maximal runs of so many letters at least."""
    return re.compile(f"[A-Za-zÀ-ÿ]{{{min_length},}}")


def words_of(doc_id: str | None, text: str, every: int = EVERY, min_length: int = MIN_LENGTH) -> Counter:
    """The words of a text with their counts: runs of letters, A-Z lower-cased, some of them short of a letter. Runs
    below ``min_length`` are left out, for words are no longer than their runs."""
    low: Counter = Counter()
    for run, n in Counter(runs_of(min_length).findall(text)).items():
        low[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    if doc_id is None:
        return low
    out: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in low.items():
        h = zlib.crc32(run.encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def count_words(docs: DataFrame, every: int = EVERY, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n over all whole texts, the words long and common enough. Each task adds its own counts up first.

    Null texts have no words; the runs of a row without an id keep all their letters; repeated rows count again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                for w, n in words_of(doc_id, text, every, min_length).items():
                    if len(w) >= min_length:
                        sums[w] += n
                if len(sums) >= FLUSH:
                    yield pd.DataFrame({"word": list(sums), "n": list(sums.values())})
                    sums.clear()
        yield pd.DataFrame({"word": pd.Series(list(sums), dtype=object), "n": pd.Series(list(sums.values()), dtype="int64")})

    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (texts.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def vectors(words: list[str]) -> np.ndarray:
    """Counts of each word's letters by group."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    slot = np.repeat(np.arange(len(words)), size) * GROUPS + code % GROUPS
    return np.bincount(slot, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def parts_in_reach(vector: tuple[int, ...], firsts: list[tuple[int, ...]], least: int = 0) -> list[int]:
    """The parts from ``least`` on (by the first vector of each, in order) that may hold a vector within one surplus and one deficit
    of this one."""
    found: set[int] = set()
    todo = [((), 0, len(firsts) - 1, 1, 1)]
    while todo:
        prefix, lo, hi, surplus, deficit = todo.pop()
        if hi < least:
            continue
        depth = len(prefix)
        if lo == hi or depth == GROUPS:
            found.update(range(max(lo, least), hi + 1))
            continue
        own = vector[depth]
        for c in range(max(0, own - deficit), own + surplus + 1):
            first = bisect_left(firsts, (*prefix, c), lo + 1, hi + 1) - 1
            last = bisect_left(firsts, (*prefix, c + 1), lo + 1, hi + 1) - 1
            todo.append(((*prefix, c), first, last, surplus - max(0, c - own), deficit - max(0, own - c)))
    return sorted(found)


def search(trie: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Depth-first over a trie, given as sorted vectors: pairs (row of asked, row of trie) within one surplus and one deficit.
    All words that still have a budget at a node go down together."""
    n = len(asked)
    todo = [(0, 0, len(trie), np.arange(n), np.ones(n, dtype=np.int64), np.ones(n, dtype=np.int64))]
    while todo:
        depth, lo, hi, who, surplus, deficit = todo.pop()
        if not who.size:
            continue
        if hi - lo <= LEAF or depth == GROUPS:
            own = asked[who, depth:]
            for row in range(lo, hi):
                more = trie[row, depth:] - own
                up = np.maximum(more, 0).sum(1)
                fits = np.flatnonzero((up <= surplus) & (up - more.sum(1) <= deficit))
                if fits.size:
                    yield who[fits], np.full(fits.size, row)
            continue
        column = trie[lo:hi, depth]
        edges = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), hi - lo]
        own = asked[who, depth]
        for a, b in zip(edges, edges[1:], strict=False):
            more = column[a] - own
            s, d = surplus - np.maximum(more, 0), deficit - np.maximum(-more, 0)
            keep = (s >= 0) & (d >= 0)
            todo.append((depth + 1, lo + a, lo + b, who[keep], s[keep], d[keep]))


def near_words(words: DataFrame) -> DataFrame:
    """Of word and n (stored, words distinct): word, n_near and the commonest near word (near, near_n; ties: the smallest) of each
    word with any. What the driver holds is one vector for every PART words."""
    spark = words.sparkSession

    @F.pandas_udf("array<int>")
    def path(w: pd.Series) -> pd.Series:
        return pd.Series(list(vectors(w.tolist()).astype(np.int32)))

    placed = number_rows(words.select("word", "n", path("word").alias("path")), F.col("path"), F.col("word"), name="no")
    placed = materialize(placed.select("word", "n", F.expr(f"no div {PART}").cast("int").alias("part"), (F.col("no") % PART).alias("at"), "path"), "spelling-trie")
    cuts = sorted((r["part"], tuple(r["path"])) for r in placed.where(F.col("at") == 0).select("part", "path").collect())
    if not cuts:
        return spark.createDataFrame([], "word string, n_near long, near string, near_n long")
    firsts = spark.sparkContext.broadcast([p for _, p in cuts])

    @F.pandas_udf("array<int>")
    def reach(w: pd.Series, part: pd.Series) -> pd.Series:
        return pd.Series([np.array(parts_in_reach(tuple(v), firsts.value, p), dtype=np.int32)
                          for v, p in zip(vectors(w.tolist()).tolist(), part.tolist(), strict=True)])

    # a pair of words in two parts is found once, by the word of the earlier part, and counts for both
    visits = materialize(placed.select("word", "n", F.col("part").alias("home")).repartition(len(cuts), "home")
                         .select("word", "n", "home", F.explode(reach("word", "home")).alias("part")), "spelling-visits")
    tasks = materialize(visits.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / VISITS).cast("int").alias("tasks"))
                         .withColumnRenamed("part", "p"), "spelling-tasks")
    n_tasks = tasks.agg(F.sum("tasks")).first()[0]
    tasks = small(tasks)
    visits = visits.join(tasks, F.col("part") == F.col("p")).select(
        "part", F.pmod(F.xxhash64("word"), F.col("tasks")).cast("int").alias("task"), F.when(F.col("home") == F.col("part"), 1).otherwise(2).alias("kind"),
        "word", "n")
    index = placed.join(tasks, F.col("part") == F.col("p")).select(
        "part", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("kind"), "word", "n")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, ns, trie = None, [], [], None        # the part that is searched, its words and counts, its trie
        for b in batches:
            for key, rows in b.groupby(["part", "task"], sort=True):
                if key != now:
                    now, held, ns, trie = key, [], [], None
                own = rows[rows["kind"] == 0]
                if len(own):
                    held += own["word"].tolist()
                    ns += own["n"].tolist()
                asking = rows[rows["kind"] > 0]
                if not len(asking):
                    continue
                if trie is None:
                    grid = vectors(held)
                    order = np.lexsort(grid.T[::-1])
                    trie, held, ns = grid[order], [held[i] for i in order], [ns[i] for i in order]
                asked, n_asked, far = asking["word"].tolist(), asking["n"].tolist(), (asking["kind"] == 2).tolist()
                best: dict[str, list] = {}

                def note(word: str, near: str, n: int) -> None:
                    b0 = best.setdefault(word, [0, -1, ""])
                    b0[0] += 1
                    if n > b0[1] or (n == b0[1] and near < b0[2]):
                        b0[1:] = n, near

                for who, row in search(trie, vectors(asked)):
                    for i, j in zip(who.tolist(), row.tolist(), strict=True):
                        if one_edit(asked[i], held[j]):
                            note(asked[i], held[j], ns[j])
                            if far[i]:
                                note(held[j], asked[i], n_asked[i])
                if best:
                    yield pd.DataFrame({"word": list(best), "n_near": [v[0] for v in best.values()],
                                        "near": [v[2] for v in best.values()], "near_n": [v[1] for v in best.values()]})

    # as many partitions as tasks: the searches are long for the few bytes they read
    dealt = index.unionByName(visits).repartition(n_tasks, "part", "task").sortWithinPartitions("part", "task", "kind")
    found = dealt.mapInPandas(run, "word string, n_near long, near string, near_n long")
    first = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b"))
            .select("word", "n_near", F.col("b.near").alias("near"), (-F.col("b.minus")).alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """Of word and form: word and root, the last of its chain of forms. The chains grow at least RATIO-fold in n, so they are short; each
    round doubles the steps taken."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("from"), F.col("root").alias("to"))
        now = materialize(now.join(step, F.col("root") == F.col("from"), "left").select(
            "word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n for a table of distinct words with their counts n.

    Two words are near if one inserted, deleted or replaced code point makes one the other. A word's form is its
    near word of largest n (ties: the smallest in code-point order) if that is ``ratio`` times as common, else null; its root is the end of
    the chain of forms, the word itself if it has none. Other columns are dropped; null words are left out; an empty table gives an empty result.
    """
    words = materialize(words.where(F.col("word").isNotNull()).select("word", "n"), "spelling-words")
    near = near_words(words).withColumnRenamed("word", "w")
    kept = F.col("near_n") >= F.col("n") * ratio
    judged = materialize(words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", F.when(kept, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(kept, F.col("near_n")).alias("form_n")), "spelling-judged")
    ends = roots(judged.where(F.col("form").isNotNull())).withColumnRenamed("word", "w")
    return judged.join(ends, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(count_words(read(spark, sf_dir, "documents")))


ORACLE = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY doc_id, run),
hashed AS (SELECT *, CASE WHEN doc_id IS NULL THEN 1 ELSE {crc_sql("(doc_id || ':' || run)")} END AS h FROM counted, tab),
words AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {MIN_LENGTH} AND sum(c) >= {MIN_COUNT}),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
pairs AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.short = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.short = b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r FROM pairs),
judged AS (
  SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near, CASE WHEN p.other_n >= {RATIO} * w.n THEN p.other END AS form,
         CASE WHEN p.other_n >= {RATIO} * w.n THEN p.other_n END AS form_n
  FROM words w LEFT JOIN ranked p ON w.word = p.word AND p.r = 1),
chain AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON c.next = j.word)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n FROM judged j JOIN chain c ON j.word = c.word AND c.next IS NULL
"""
