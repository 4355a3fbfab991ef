"""Language identification (3): error-correcting output codes over binary n-gram classifiers.

Each language has a codeword; for each bit a naive Bayes classifier over hashed byte trigrams tells languages
with a 1 from those with a 0. A text's margins are decoded to the codeword with the least weighted logistic
loss; a runner-up nearly as close flags the text as ambiguous. All training texts are counted, none sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import read

SLOTS = 1 << 13        # hashed trigrams
CHUNK = 1 << 20        # bytes that numpy works on at once
SMOOTH = 0.5
SCALE = 4.0            # of margins before the loss
AMBIGUOUS = 0.15       # runner-up within this share of probability
UNKNOWN = "und"

#: ASCII bytes other than lower-case letters count as a space.
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], dtype=np.uint32)


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Slots of the byte trigrams of a text, in pieces; those of white space alone are left out."""
    data = f"  {text.lower()} ".encode("utf-8", "replace")
    for at in range(0, len(data) - 2, CHUNK):
        b = _FOLD[np.frombuffer(data[at:at + CHUNK + 2], dtype=np.uint8)]
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        code = code[code != 0x202020]
        code *= np.uint32(2654435761)
        yield code >> np.uint32(19)      # the top 13 bits


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 / -1: every two-way split of up to 5 languages, else random columns (the best of 50 draws by least distance)."""
    if n < 2:
        return np.zeros((n, 0), dtype=np.float32)
    if n <= 5:
        return np.array([[1 if i == 0 or m >> (i - 1) & 1 else -1 for i in range(n)] for m in range(2 ** (n - 1) - 1)], dtype=np.float32).T
    rng, best, far = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], dtype=np.float32), size=(n, bits))
        code = code[:, abs(code.sum(0)) < n]
        gap = min(((code[i] != code[i + 1:]).sum(1).min() for i in range(n - 1)))
        if gap > far:
            best, far = code, gap
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray           # languages x bits
    weights: np.ndarray        # slots x bits: log likelihood ratios
    bit_weight: np.ndarray     # how well a bit's two sides are told apart


def fit(counts: pd.DataFrame) -> Model:
    """counts: lang, slot, n."""
    langs = tuple(sorted(counts["lang"].unique()))
    table = np.full((len(langs), SLOTS), SMOOTH)
    np.add.at(table, (counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=int), counts["slot"].to_numpy(dtype=int)),
              counts["n"].to_numpy(dtype=float))
    p = table / table.sum(1, keepdims=True)
    code = codewords(len(langs))
    on, off = (code > 0).astype(float), (code < 0).astype(float)
    p1 = (on / np.maximum(on.sum(0), 1)).T @ p
    p0 = (off / np.maximum(off.sum(0), 1)).T @ p
    ratio = np.log(p1) - np.log(p0)
    apart = ((p1 - p0) * ratio).sum(1)          # symmetric divergence of the two sides
    return Model(langs, code, ratio.T.astype(np.float32), apart / apart.sum() if apart.size else apart)


def margins(text: str, m: Model) -> np.ndarray:
    total, n = np.zeros(m.code.shape[1]), 0
    for slots in trigrams(text):
        total += np.bincount(slots, minlength=SLOTS).astype(np.float32) @ m.weights if slots.size > SLOTS else m.weights[slots].sum(0)
        n += slots.size
    return total / max(n, 1)


def decode(margin: np.ndarray, m: Model) -> tuple[str, float, bool]:
    """Language, its probability and whether the runner-up is close."""
    if len(m.languages) < 2:
        return (m.languages[0], 1.0, False) if m.languages else (UNKNOWN, 0.0, False)
    loss = (np.logaddexp(0, -m.code * margin * SCALE) * m.bit_weight).sum(1) * m.code.shape[1]
    p = np.exp(loss.min() - loss)
    p /= p.sum()
    order = np.argsort(-p, kind="stable")
    return m.languages[order[0]], float(p[order[0]]), bool(p[order[0]] - p[order[1]] < AMBIGUOUS)


def count_trigrams(labelled: DataFrame) -> DataFrame:
    """lang, slot, n over all labelled texts; each task sums its own first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                if has_letter(text):
                    own = sums.setdefault(lang, np.zeros(SLOTS, dtype=np.int64))
                    for slots in trigrams(text):
                        own += np.bincount(slots, minlength=SLOTS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "slot": at, "n": own[at]})

    return labelled.select("lang", "text").mapInPandas(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n"))


def train(labelled: DataFrame) -> Model:
    """From lang and text; at most SLOTS sums for each language reach the driver. Rows with a null in either are left out."""
    return fit(count_trigrams(labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())).toPandas())


def identify(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with lang_pred, score and ambiguous, from column text alone.

    A text that is null or has no letter, or any text when nothing was learned, is ``und`` with score 0. Ties go to the language first in
    code point order; repeated rows are judged alike; an empty table gives an empty result. Clashing columns are replaced.
    """
    spread = docs.sparkSession.sparkContext.broadcast(model)      # SLOTS x bits floats

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = spread.value
        for b in batches:
            got = [decode(margins(t, m), m) if has_letter(t) else (UNKNOWN, 0.0, False) for t in b]
            yield pd.DataFrame(got, columns=["lang_pred", "score", "ambiguous"])

    # only the text goes to Python: the other columns stay as they are
    own = [F.col(f"`{c}`") for c in columns if c not in ("lang_pred", "score", "ambiguous")]
    return docs.select(*own, judge(F.col("text")).alias("__judged")).select(*own, "__judged.*")


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", bucket(F.col("doc_id"), 4) == 2)
    return identify(docs, train(docs.where(~F.col("held_out"))), ["doc_id", "held_out"])
