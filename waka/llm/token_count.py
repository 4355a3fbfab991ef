"""Token counts (8): byte-pair merging with a heap and a linked list.

The symbols of a pre-token stand in a linked list; a heap holds the adjacent pairs that can merge, lowest
rank first. Each pop merges one pair, so the count is the number of bytes minus the number of merges.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import read

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
CACHED = 400_000       # pre-tokens whose counts a worker keeps
_WIDTH = 1 << 20       # above any symbol's number


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


def merge_count(symbols: list[int], ranks: dict[int, tuple[int, int]]) -> int:
    """Tokens that remain of a list of symbols. ranks: left * _WIDTH + right -> (rank, merged symbol)."""
    n = len(symbols)
    heap = [(r[0], i, k) for i in range(n - 1) if (r := ranks.get(k := symbols[i] * _WIDTH + symbols[i + 1]))]
    if not heap:
        return n
    heapify(heap)
    left, right, size, merges = list(range(-1, n - 1)), list(range(1, n + 1)), n, 0
    while heap:
        _, i, k = heappop(heap)
        j = right[i]
        if symbols[i] < 0 or j >= size or symbols[i] * _WIDTH + symbols[j] != k:
            continue        # one of the pair has been merged meanwhile
        symbols[i], symbols[j] = ranks[k][1], -1
        merges += 1
        right[i] = after = right[j]
        if after < size:
            left[after] = i
            if r := ranks.get(q := symbols[i] * _WIDTH + symbols[after]):
                heappush(heap, (r[0], i, q))
        if (before := left[i]) >= 0 and (r := ranks.get(q := symbols[before] * _WIDTH + symbols[i])):
            heappush(heap, (r[0], before, q))
    return n - merges


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Callable[[str], int]:
    """Counts the tokens of a text as the vocabulary file says; loaded once a worker."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids: dict[str, int] = {}
    number = lambda s: ids.setdefault(s, len(ids))
    letters = [number(c) for c in byte_letters()]
    ranks: dict[int, tuple[int, int]] = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        ranks.setdefault(number(a) * _WIDTH + number(b), (rank, number(a + b)))
    specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    cut = regex.compile("|".join(map(regex.escape, specials))) if specials else None
    find = regex.compile(pattern).findall
    seen: dict[str, int] = {}

    def count(text: str) -> int:
        total = 0
        parts = [text]
        if cut and any(s in text for s in specials):
            parts = cut.split(text)
            total = len(parts) - 1
        for part in parts:
            for token in find(part):
                n = seen.get(token)
                if n is None:
                    n = merge_count([letters[b] for b in token.encode()], ranks)
                    if len(token) <= 64:
                        if len(seen) >= CACHED:
                            seen.clear()
                        seen[token] = n
                total += n
        return total

    return count


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text.

    A null or empty text has 0 bytes and 0 tokens; special strings inside a text are one token each; repeated
    rows count alike; other columns are dropped. ``vocabulary`` is a file of public_tokenizers.
    """

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers

        count = counter(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
        for b in batches:
            yield pd.Series([count(t) if t else 0 for t in b], dtype="int64")

    # only the text goes to Python: the id stays as it is
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return docs.select("doc_id", n_bytes, tokens(F.col("text")).alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))
