"""Toxicity (5): a subsequence string-kernel support vector machine with Nystroem landmarks.

A text is read as its words, with punctuation inside a word dropped and runs of single letters joined. The kernel counts common
subsequences of SUB letters, each shrunk by DECAY for every letter it spans, so an insult with gaps or
inserted letters stays close to the insult. A text's vector holds, for each landmark, the kernel of its closest word;
the machine is trained on the vectors of labelled documents with the documents' own labels, so that all its evidence counts together,
and is calibrated on labelled documents that neither the landmarks nor the machine have seen.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import materialize, read
from waka.llm.language_id import bucket

SAMPLE = 4000          # labelled documents of each class that the model is fitted on, at most
LANDMARKS = 96         # three quarters of them marking words; other words are seen through their kernels with these
CLOSE = 0.55           # a word whose kernel with a landmark reaches this is no new landmark
COMMON = 3000          # common words that plain landmarks are chosen from, at most
HELD = 4               # one in so many labelled documents calibrates and is not fitted on
SUB, DECAY = 3, 0.6
LONGEST = 31           # letters of a piece; longer words are read in overlapping pieces
SLOT_BITS = 18         # a worker keeps the vectors of so many bits of units
SLOTS = 1 << SLOT_BITS
CHUNK = 500_000        # characters of texts that are looked up at once
THRESHOLD = 0.7

_LETTERS = re.compile(r"[^\W\d_]+")
_SINGLES = re.compile(r"(?<!\S)(?:\S\s{1,2}){3,}\S(?!\S)")


def units(token: str) -> list[str]:
    """What a token of a lower-cased text may say: its letter runs, and all of them joined; in pieces of LONGEST letters."""
    if SUB <= len(token) <= LONGEST and token.isalpha():
        return [token]
    parts = _LETTERS.findall(token)
    if len(parts) > 1:
        parts.append("".join(parts))
    return [p[i:i + LONGEST] for p in parts if len(p) >= SUB
            for i in (range(0, len(p) - LONGEST // 2, LONGEST // 2) if len(p) > LONGEST else (0,))]


def tokens(text: str) -> set[str]:
    """Distinct tokens of a text, spelled-out words included."""
    low = text.lower()
    return {*low.split(), *("".join(x.split()) for x in _SINGLES.findall(low))}


def _grid(words: list[str]) -> np.ndarray:
    """Code points of each word's letters, 0 past its end."""
    if not words:
        return np.zeros((0, 1), dtype=np.uint32)
    text = np.array(words, dtype=f"U{LONGEST}")
    return text.view(np.uint32).reshape(len(words), -1)[:, :max(1, max(map(len, words), default=1))]


@functools.cache
def _decays(n: int) -> np.ndarray:
    """Powers of DECAY by distance, of each place to those before it."""
    far = np.arange(n)[:, None] - np.arange(n)[None, :]
    return np.where(far >= 0, DECAY ** np.maximum(far, 0), 0.0)


def raw_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Subsequence kernel of each row of a with the same row of b (code points; 0 is past the end)."""
    n, la, lb = len(a), a.shape[1], b.shape[1]
    same = DECAY ** 2 * ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] > 0))
    ahead = np.ones((n, la, lb))       # weight of the common subsequences that end before each pair of places
    for _ in range(SUB - 1):
        ends = _decays(la) @ (same * ahead) @ _decays(lb).T
        ahead = np.zeros((n, la, lb))
        ahead[:, 1:, 1:] = ends[:, :-1, :-1]
    return (same * ahead).sum((1, 2))


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray     # of the kernel values (the Nystroem map folded in)
    bias: float
    slope: float            # of the calibration
    offset: float

    def __post_init__(self) -> None:
        letters = {c: i + 1 for i, c in enumerate(sorted({c for w in self.landmarks for c in w}))}
        self.number = np.zeros(0x110000, dtype=np.int32)     # of a letter by code point
        for c, i in letters.items():
            self.number[ord(c)] = i
        self.sizes = np.array([len(w) for w in self.landmarks], dtype=np.int64)
        self.grid = _grid(self.landmarks)
        self.norm = np.sqrt(raw_kernel(self.grid, self.grid))
        self.base = len(letters) + 1
        parts: dict[int, np.ndarray] = {}                    # of a subsequence (a number to the base): its weight in each landmark
        for k, row in enumerate(self.number[self.grid].astype(np.int64)):
            row = row[:self.sizes[k]]
            at, weight = _triples(len(row))
            for code, v in zip(self._code(row[None, :], at)[0].tolist(), weight.tolist(), strict=True):
                parts.setdefault(code, np.zeros(len(self.landmarks)))[k] += v
        self.codes = np.array(sorted(parts), dtype=np.int64)
        self.table = np.array([parts[c] for c in sorted(parts)]).reshape(len(parts), len(self.landmarks))

    def _code(self, letters: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (letters[:, at[0]] * self.base + letters[:, at[1]]) * self.base + letters[:, at[2]]

    @functools.cached_property
    def place(self) -> np.ndarray | None:
        """Where each subsequence (by its number) stands in codes, -1 if no landmark holds it; None if that would be too large."""
        if self.base ** SUB > 1 << 23:
            return None
        place = np.full(self.base ** SUB, -1, dtype=np.int32)
        place[self.codes] = np.arange(len(self.codes))
        return place

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "place"}

    def kernel(self, words: list[str]) -> np.ndarray:
        """Normalised kernel of words with landmarks, squared (again a kernel).

        The sum over common subsequences is taken subsequence by subsequence: of a word's, those that some landmark holds.
        """
        out = np.zeros((len(words), len(self.landmarks)))
        if not words or not len(self.codes):
            return out
        size, place = np.array([len(w) for w in words]), self.place
        for n in np.unique(size):
            if n < SUB:
                continue
            at, weight = _triples(int(n))
            chosen, step = np.flatnonzero(size == n), max(1, 1_000_000 // max(len(weight), len(self.codes)))
            for rows in (chosen[i:i + step] for i in range(0, len(chosen), step)):
                grid = _grid([words[i] for i in rows])
                letters = self.number[grid].astype(np.int32 if place is not None else np.int64)
                some = np.flatnonzero((letters > 0).sum(1) >= SUB)
                code = self._code(letters[some], at)
                if place is not None:
                    found = place[code]
                else:
                    found = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                    found[self.codes[found] != code] = -1
                w, t = np.nonzero(found >= 0)
                if not w.size:
                    continue
                held = np.bincount(w * len(self.codes) + found[w, t], weight[t], len(some) * len(self.codes)).reshape(len(some), -1)
                own = np.sqrt(raw_kernel(grid[some], grid[some]))
                out[rows[some]] = (held @ self.table / (own[:, None] * self.norm)) ** 2
        return out

    def shades(self, words: list[str]) -> np.ndarray:
        """The kernel in steps of 1/255, as it is stored for each word."""
        return np.rint(255 * np.minimum(self.kernel(words), 1)).astype(np.uint8)

    def values(self, vectors: np.ndarray) -> np.ndarray:
        """Of texts' vectors, in steps of 1/255."""
        return vectors @ (self.weights / 255) + self.bias


@functools.cache
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (SUB rows) and weights of all subsequences of SUB of n letters."""
    at = np.array(list(itertools.combinations(range(n), SUB)), dtype=np.int64).reshape(-1, SUB).T
    return at, DECAY ** (at[-1] - at[0] + 1)


def hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 0.5, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Linear support vector machine by dual coordinate descent; the bias is a constant feature."""
    x = np.hstack([x, np.ones((len(x), 1))])
    alpha, w, q = np.zeros(len(x)), np.zeros(x.shape[1]), (x * x).sum(1)
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            step = np.clip(alpha[i] - (y[i] * (x[i] @ w) - 1) / q[i], 0, c * weight[i]) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
    return w[:-1], float(w[-1])


def calibrate(value: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset by damped Newton steps, slightly regularised."""
    v, a, b = np.clip(value, -3, 3), 1.0, 0.0
    cost = lambda a, b: (weight * np.logaddexp(0, (1 - 2 * y) * (a * v + b))).sum() + 0.01 * (a * a + b * b)
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a * v + b)))
        s = weight * p * (1 - p)
        g = np.array([(weight * (p - y) * v).sum() + 0.02 * a, (weight * (p - y)).sum() + 0.02 * b])
        h = np.array([[(s * v * v).sum() + 0.02, (s * v).sum()], [(s * v).sum(), s.sum() + 0.02]])
        da, db = np.linalg.solve(h, g)
        step, now = 1.0, cost(a, b)
        while step > 1e-6 and cost(a - step * da, b - step * db) > now:
            step /= 2
        a, b = a - step * da, b - step * db
    return max(float(a), 1e-3), float(b)


def pick_landmarks(stats: pd.DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """From unit, toxic, clean (documents of the sample that hold it): landmarks.
    These are words that mark toxic documents and aren't close to one before, then common clean words."""
    t, c = (stats["toxic"] + 0.1) / max(n_toxic, 1), (stats["clean"] + 0.1) / max(n_clean, 1)
    marking = (stats["toxic"] >= (3 if n_toxic >= 200 else 2)) & (t / (t + c) >= 0.95)
    own = stats[marking].sort_values(["toxic", "unit"], ascending=[False, True])["unit"].tolist()
    plain = stats[t / (t + c) <= 0.6].sort_values(["clean", "unit"], ascending=[False, True])["unit"].tolist()
    picked: list[str] = []
    for at in range(0, len(own), LANDMARKS):       # kernels among a few candidates at a time
        few = own[at:at + LANDMARKS]
        near, among = Model(picked, np.zeros(len(picked)), 0.0, 1.0, 0.0).kernel(few), Model(few, np.zeros(len(few)), 0.0, 1.0, 0.0).kernel(few)
        new: list[int] = []
        for i, w in enumerate(few):
            if len(picked) < LANDMARKS * 3 // 4 and near[i].max(initial=0) < CLOSE and among[i, new].max(initial=0) < CLOSE:
                new.append(i)
                picked.append(w)
        if len(picked) == LANDMARKS * 3 // 4:
            break
    return picked + plain[:LANDMARKS // 4]


def fit(picked: list[str], vectors: np.ndarray, toxic: np.ndarray) -> Model:
    """The machine that tells the vectors of toxic documents from those of clean ones; either side weighs the same."""
    model = Model(picked, np.zeros(len(picked)), -1.0, 1.0, 0.0)
    n1, n0 = int(toxic.sum()), int((1 - toxic).sum())
    if not n1 or not n0 or not picked:
        return model
    gram = model.kernel(picked)
    val, vec = np.linalg.eigh((gram + gram.T) / 2)
    keep = val > 0.02
    root = vec[:, keep] / np.sqrt(val[keep])          # Nystroem: k -> k K^(-1/2)
    w, b = hinge(vectors / 255 @ root, np.where(toxic == 1, 1.0, -1.0), np.where(toxic == 1, max(1, n0 / n1), max(1, n1 / n0)))
    return Model(picked, root @ w, b, 1.0, 0.0)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, the class's weight and held (kept for the calibration) of at most SAMPLE labelled documents of each class, those with the least hash of their id.
    A repeated id counts as toxic if any of its labels is."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")).where(bucket(F.col("doc_id"), 3) != 1))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
             .withColumn("weight", F.lit(n.get(t, 0) / max(1, min(n.get(t, 0), SAMPLE)))) for t in (0, 1)]
    ids = parts[0].union(parts[1]).withColumnRenamed("doc_id", "__id")      # at most 2 * SAMPLE rows
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("__id")).select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic", "weight", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(HELD)) == 0).alias("held"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The words of the sample are counted by Spark; the driver gets the COMMON commonest and the LANDMARKS * 40 that most mark toxic
    documents, and a vector of LANDMARKS bytes for each document of the sample."""
    some = materialize(sample(docs, labels), "toxic-sample")

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(u, t) for text, t in zip(b["text"], b["toxic"], strict=True)
                    for u in {u for token in tokens(text) for u in units(token)}]
            yield pd.DataFrame(rows, columns=["unit", "toxic"])

    size = {(r["toxic"], r["held"]): r["count"] for r in some.groupBy("toxic", "held").count().collect()}
    apart = all(size.get((t, h), 0) >= (1 if h else 2) for t in (0, 1) for h in (False, True))   # else there are too few to hold any back
    known = some.where(~F.col("held")) if apart else some
    n1, n0 = (size.get((t, False), 0) + (0 if apart else size.get((t, True), 0)) for t in (1, 0))
    count = materialize(known.select("text", "toxic").mapInPandas(listed, "unit string, toxic int").groupBy("unit").agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("clean")), "toxic-words")
    lift = F.col("toxic") / max(n1, 1) - F.col("clean") / max(n0, 1)
    stats = (count.orderBy(F.desc(lift), "unit").limit(LANDMARKS * 40)
             .union(count.orderBy(F.desc("clean"), "unit").limit(COMMON)).distinct().toPandas())
    picked = pick_landmarks(stats, n1, n0)
    blank = Model(picked, np.zeros(len(picked)), -1.0, 1.0, 0.0)

    @F.pandas_udf("binary")
    def vector(text: pd.Series) -> pd.Series:
        return pd.Series([v.tobytes() for v in text_vectors(blank, text.tolist())], dtype=object)

    seen = some.select("toxic", "weight", "held", vector("text").alias("vector")).toPandas()
    seen = seen.sort_values(["toxic", "held", "weight", "vector"])      # one order, however the rows were dealt
    vectors = np.frombuffer(b"".join(seen["vector"]), dtype=np.uint8).reshape(len(seen), len(picked))
    toxic, held = (seen["toxic"] == 1).to_numpy(float), seen["held"].to_numpy(bool)
    used = ~held if apart else np.full(len(seen), True)
    model = fit(picked, vectors[used], toxic[used])
    if n1 and n0:
        rest = held if apart else used
        model.slope, model.offset = calibrate(model.values(vectors[rest]), toxic[rest], seen["weight"].to_numpy()[rest])
    return model


class Kept:
    """The vectors of units that a worker has met, in a table of SLOTS places by the units' hashes; a unit replaces the one that had its place."""

    def __init__(self, model: Model):
        self.model = model
        self.hashes = np.zeros(SLOTS, dtype=np.uint64)      # 0: an empty place
        self.rows = np.zeros((SLOTS, len(model.landmarks)), dtype=np.uint8)

    def find(self, units_of_texts: list[set[str]]) -> np.ndarray:
        """The largest kernel with each landmark of any unit of each text, in steps of 1/255."""
        wanted = sorted(set().union(*units_of_texts))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(u) | 1 for u in wanted), dtype=np.uint64, count=len(wanted))
        place = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        fresh = np.flatnonzero(self.hashes[place] != hashes)
        vectors = self.rows[place]
        if fresh.size:
            vectors[fresh] = self.model.shades([wanted[i] for i in fresh])
            self.hashes[place[fresh]], self.rows[place[fresh]] = hashes[fresh], vectors[fresh]
        number = dict(zip(wanted, range(len(wanted)), strict=True))
        out = np.zeros((len(units_of_texts), vectors.shape[1]), dtype=np.uint8)
        for i, own in enumerate(units_of_texts):
            if own:
                out[i] = vectors[[number[u] for u in own]].max(0)
        return out


_KEPT: list[Kept] = []


def text_vectors(model: Model, texts: list[str | None]) -> np.ndarray:
    """The vector of each text; a worker keeps those of units for one list of landmarks."""
    from waka.llm import toxicity as here      # the worker's own module, which outlives a task

    if not here._KEPT or here._KEPT[0].model.landmarks != model.landmarks:
        here._KEPT[:] = [Kept(model)]
    out, at = np.zeros((len(texts), len(model.landmarks)), dtype=np.uint8), 0
    while at < len(texts):
        some, end, n = [], at, 0
        while end < len(texts) and n < CHUNK:
            some.append({u for t in tokens(texts[end]) for u in units(t)} if texts[end] else set())
            n += len(texts[end] or "")
            end += 1
        out[at:end] = here._KEPT[0].find(some)
        at = end
    return out


def score(model: Model, text: Column) -> Column:
    """Between 0 and 1, higher for texts likelier to be toxic. Null and empty texts score as a text without any insult; whole texts are read."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            value = np.clip(model.values(text_vectors(model, b.tolist())), -3, 3)
            yield pd.Series(1 / (1 + np.exp(-(model.slope * value + model.offset))))

    return of(text)


def score_documents(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD), from column text alone.

    Repeated rows score alike; columns of these names are replaced; only the text goes to Python.
    """
    own = [F.col(f"`{c}`") for c in columns if c not in ("score", "predicted")]
    return docs.select(*own, score(model, F.col("text")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    return score_documents(docs.withColumn("held_out", bucket(F.col("doc_id"), 3) == 1), model, ["doc_id", "held_out"])
