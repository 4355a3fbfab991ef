"""License scans (4): a positional index of rare licence words.

Every template has mandatory key-phrase words at fixed positions. It is posted, with their positions, under those RARE of these words that
have the highest inverse document frequency in the corpus. A file's occurrences of such words, each less the word's position in
the template, are the places where the template may start; the lists of a template's rare words are intersected, and a
place that all of them name stands if the key phrase is all there and enough of the template's other words are at their relative positions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import ascii_lower, let, read, words

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVERAGE = 0.8
RARE = 3              # words that a template is posted under, at most


@dataclass(frozen=True)
class Template:
    label: str
    text: str                 # words
    key: tuple[int, int]      # the words from key[0] to key[1] (exclusive) are mandatory
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# The base phrases and labels of the contract.
BASE = [
    Template("mit", "under the mit license", (0, 4), True),
    Template("apache-2", "apache license version 2", (0, 4), True),
    Template("cc-by-nc", "cc by nc", (0, 3), True),
]
# Opening or granting sentences of public licences, their identifiers, and whole texts.
MORE = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", (0, 7)),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", (6, 12)),
    Template("gpl-3", "gnu general public license version 3", (0, 6)),
    Template("gpl-2", "gnu general public license version 2", (0, 6)),
    Template("lgpl-3", "gnu lesser general public license version 3", (0, 7)),
    Template("mpl-2", "mozilla public license v 2 0", (0, 5)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", (0, 8)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", (0, 9)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", (3, 6)),
    Template("cc-by-sa", "cc by sa", (0, 3)),
    Template("agpl-3", "gnu affero general public license version 3", (0, 7)),
    Template("cc-by", "creative commons attribution 4 0", (0, 5)),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0", (0, 6)),
    Template("mit", "terms of the mit license", (0, 5)),
    Template("mit", "spdx license identifier mit", (0, 4)),
    Template("apache-2", "spdx license identifier apache 2 0", (0, 6)),
    Template("gpl-3", "spdx license identifier gpl 3 0", (0, 6)),
    Template("gpl-2", "spdx license identifier gpl 2 0", (0, 6)),
    Template("bsd", "spdx license identifier bsd", (0, 4)),
    Template("mpl-2", "spdx license identifier mpl 2 0", (0, 6)),
    Template("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
        the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
        sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions
        the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
        the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
        fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other
        liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings
        in the software""", (0, 7)),
    Template("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
        the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties
        with regard to this software including all implied warranties of merchantability and fitness""", (0, 9)),
]


def frequencies(tokens: DataFrame, templates: list[Template]) -> tuple[dict[str, int], int]:
    """Documents with each key-phrase word, and documents: one row per word of the templates reaches the driver."""
    vocabulary = sorted({w for t in templates for w in t.words[slice(*t.key)]})
    found = tokens.select(F.explode(F.array_union(F.array(F.lit(None).cast("string")), F.array_intersect(
        "__w", F.array(*map(F.lit, vocabulary))))).alias("word")).groupBy("word").count()
    df = {r["word"]: r["count"] for r in found.collect()}
    return df, df.pop(None, 0)


def anchors(template: Template, df: dict[str, int], n: int) -> list[tuple[str, int]]:
    """(word, position) of the template's rarest different mandatory words, each at its first place in the phrase."""
    idf = lambda w: math.log((n + 1) / (df.get(w, 0) + 1))
    first: dict[str, int] = {}
    for j in range(*template.key):
        first.setdefault(template.words[j], j)
    return sorted(first.items(), key=lambda p: (-idf(p[0]), p[1]))[:RARE]


def _places(w: Column, templates: list[Template], posts: list[list[tuple[str, int]]]) -> Column:
    """Array of (t, at, coverage): the verified places of all templates."""
    vocabulary = sorted({x for p in posts for x, _ in p})
    rare = F.array(*map(F.lit, vocabulary))
    leaders = F.array(*map(F.lit, sorted({p[0][0] for p in posts})))        # a template needs its rarest word
    text = F.array(*[F.array(*map(F.lit, t.words)) for t in templates])
    k0, k1 = F.array(*[F.lit(t.key[0]) for t in templates]), F.array(*[F.lit(t.key[1]) for t in templates])
    seen = F.filter(F.transform(w, lambda x, i: F.struct(i.alias("i"), F.array_position(rare, x).cast("int").alias("r"))),
                    lambda h: h["r"] > 0)

    def named(s: Column, word: str, position: int) -> Column:
        """Starts that the occurrences of a word name."""
        r = vocabulary.index(word) + 1
        return F.transform(F.filter(s, lambda h: h["r"] == r), lambda h: h["i"] - position)

    def starts(s: Column, t: int) -> Column:
        """Where template t may start: the places that all its rare words name."""
        both = reduce(F.array_intersect, [named(s, word, position) for word, position in posts[t]])
        return F.transform(both, lambda at: F.struct(F.lit(t).alias("t"), at.alias("at")))

    candidates = let(seen, lambda s: F.concat(*[starts(s, t) for t in range(len(templates))]))

    def judged(c: Column) -> Column:
        tpl = F.get(text, c["t"])
        same = F.transform(tpl, lambda x, j: F.when(c["at"] + j < 0, False).otherwise(
            F.coalesce(F.get(w, c["at"] + j) == x, F.lit(False))))
        key = F.forall(F.slice(same, F.get(k0, c["t"]) + 1, F.get(k1, c["t"]) - F.get(k0, c["t"])), lambda y: y)
        share = F.size(F.filter(same, lambda y: y)) / F.size(tpl)
        return F.struct(c["t"].alias("t"), c["at"].alias("at"), F.when(key, share).otherwise(0.0).alias("coverage"))

    found = F.filter(F.transform(candidates, judged), lambda c: c["coverage"] >= COVERAGE)
    return F.when(F.arrays_overlap(w, leaders), found).otherwise(
        F.array().cast("array<struct<t:int,at:int,coverage:double>>"))


def scan(docs: DataFrame, templates: list[Template] = (*BASE, *MORE)) -> DataFrame:
    """``docs`` with ``n_words`` and ``licenses``: array of (label, base, at, coverage), one for each place.

    Words are runs of ASCII letters and digits and of other non-ASCII characters, A-Z lower-cased. Null and empty texts
    have no words and no places; repeated rows are scanned alike; columns n_words and licenses are replaced.
    """
    templates = list(templates)
    w = words(ascii_lower(F.col("text")), PATTERN)
    df, n = frequencies(docs.select(w.alias("__w")), templates)
    labels = F.array(*[F.lit(t.label) for t in templates])
    base = F.array(*[F.lit(t.base) for t in templates])
    return (docs.drop("n_words", "licenses").withColumn("__w", w)
            .withColumn("n_words", F.size("__w").cast("long"))
            .withColumn("__p", _places(F.col("__w"), templates, [anchors(t, df, n) for t in templates]))
            .withColumn("licenses", F.transform("__p", lambda p: F.struct(
                F.get(labels, p["t"]).alias("label"), F.get(base, p["t"]).alias("base"), p["at"].cast("long").alias("at"),
                p["coverage"].alias("coverage"))))
            .drop("__w", "__p"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    got = got.withColumn("__base", F.filter("licenses", lambda p: p["base"]))
    label = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda p: p["label"]))), ",")
    at = F.transform("__base", lambda p: p["at"])
    return got.select("doc_id", "n_words", F.size("__base").cast("long").alias("n_base"),
                      F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
                      label(F.col("__base")).alias("base_labels"), label(F.col("licenses")).alias("labels"),
                      F.coalesce(F.array_max(F.transform("licenses", lambda p: p["coverage"])), F.lit(0.0)).alias("score"))


def _rows() -> str:
    return ", ".join(f"({i}, '{t.label}', {t.base}, {t.words!r}, {t.key[0]}, {t.key[1]})" for i, t in enumerate([*BASE, *MORE]))


ORACLE = rf"""
WITH tpl(t, label, base, tw, k0, k1) AS (VALUES {_rows()}),
doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS rid FROM documents),
spot AS (SELECT rid, w, unnest(range(-20, len(w))) AS pos FROM doc),
near AS (SELECT s.rid, s.pos, t.*, [coalesce(s.pos + j >= 0 AND s.w[s.pos + j + 1] = t.tw[j + 1], false) FOR j IN range(len(t.tw))] AS same
         FROM spot s JOIN tpl t ON s.pos + t.k0 >= 0 AND s.w[s.pos + t.k0 + 1] = t.tw[t.k0 + 1]),
place AS (SELECT *, len(list_filter(same, lambda x: x))::DOUBLE / len(tw) AS coverage FROM near
          WHERE len(list_filter(same[k0 + 1 : k1], lambda x: x)) = k1 - k0),
kept AS (SELECT * FROM place WHERE coverage >= {COVERAGE}),
agg AS (SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(pos) FILTER (WHERE base) AS first_word, max(pos) FILTER (WHERE base) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM kept GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(a.n_base, 0)::BIGINT AS n_base, a.first_word::BIGINT AS first_word,
       a.last_word::BIGINT AS last_word, coalesce(a.base_labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       coalesce(a.score, 0)::DOUBLE AS score
FROM doc d LEFT JOIN agg a USING (rid)
"""
