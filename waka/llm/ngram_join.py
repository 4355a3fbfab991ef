"""N-gram Jaccard join (9): vertical partitioning of the global n-gram order.

Texts are sets of distinct word 5-grams (64-bit hashes). Equal sets are one class. The global order puts
n-grams that many texts hold last, the others by hash; a class's first n-grams in that order (its prefix)
meet some of every class similar enough. The hash range is cut into FRAGMENTS, a class's set is stored
in as many pieces, each piece of a candidate pair is intersected separately, and the counts are summed per pair.

Large groups of near copies never yield all their pairs. Classes that share a min-hash are compared with the most
central of them, its hub; those that link with a hub which is itself no other hub's member form its cluster. Candidates are pairs of
clusters, and since 1 - Jaccard is a metric, a pair of clusters whose hubs are farther apart than the limit plus both
radii holds no link. The members of other pairs of clusters are joined on the few n-grams in which they differ from a hub.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waka.llm.common import BROADCAST_ROWS, LOWER, UPPER, materialize, read, small

N, PERCENT = 5, 80
FRAGMENTS = 8
SLOT_BITS = 22         # n-grams are counted in so many slots, by the first bits of their hashes; any order gives the same links
CHUNKS = 64            # the count table travels in so many pieces
FLUSH = 500_000        # n-grams a task holds to count them
MINHASHES = 4
_KIND = np.uint64(7)   # the lowest bits of a posting's token: 0 prefix, 1.. min-hash


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the runs of N words (A-Z lower-cased, ASCII white space between words); fewer words are one run."""
    w = text.encode().lower().split() if text else []
    if not w:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    runs = max(1, len(w) - N + 1)
    out = np.full(runs, len(w) if len(w) < N else N, dtype=np.uint64)
    for k in range(min(N, len(w))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + runs])
    return np.unique(out)


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit digest of a set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """kind 0: doc_id, text_hash, n, key of each row. kind 1: a chunk (n) of the task's counts by slot, one byte each."""
    table, held, size = np.zeros(1 << SLOT_BITS, dtype=np.uint8), [], 0

    def add() -> None:
        slot, n = np.unique((np.concatenate(held) >> np.uint64(64 - SLOT_BITS)).astype(np.int32), return_counts=True)
        table[slot] = np.minimum(table[slot] + n, 255)

    for b in batches:
        sizes, keys = [], []
        for text in b["text"]:
            s = shingle_set(text)
            sizes.append(len(s))
            keys.append(set_key(s))
            held.append(s)
            size += len(s)
            if size >= FLUSH:
                add()
                held, size = [], 0
        yield pd.DataFrame({"kind": 0, "doc_id": b["doc_id"], "text_hash": b["text_hash"], "n": sizes, "key": keys, "counts": None})
    if held:
        add()
    if table.any():
        parts = table.reshape(CHUNKS, -1)
        yield pd.DataFrame({"kind": 1, "doc_id": None, "text_hash": 0, "n": range(CHUNKS), "key": 0, "counts": [p.tobytes() for p in parts]})


def _add_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for chunk, counts in zip(b["n"], b["counts"], strict=True):
            got = np.frombuffer(counts, dtype=np.uint8).astype(np.uint32)
            sums[chunk] = sums[chunk] + got if chunk in sums else got
    if sums:
        yield pd.DataFrame({"n": list(sums), "counts": [v.tobytes() for v in sums.values()]})


def _count_table(first: DataFrame) -> np.ndarray:
    """The tasks' counts summed: 4 bytes for each of 2 ** SLOT_BITS slots, whatever the input."""
    got = first.where(F.col("kind") == 1).select("n", "counts").repartition("n").mapInPandas(_add_chunks, "n long, counts binary").toPandas()
    table = np.zeros((CHUNKS, (1 << SLOT_BITS) // CHUNKS), dtype=np.uint32)
    for chunk, counts in zip(got["n"], got["counts"], strict=True):
        table[chunk] += np.frombuffer(counts, dtype=np.uint32)
    return table.ravel()


def _postings(counts: Broadcast):
    """token, key, central: the prefix of each class in the global order, and its min-hashes with how common its n-grams are on the whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        table = counts.value
        for b in batches:
            tokens, keys, central = [], [], []
            for text in b["text"]:
                s = shingle_set(text)
                if not s.size or (key := set_key(s)) in done:
                    continue
                done.add(key)
                n = len(s)
                late = _heat(s, table)
                prefix = s[np.lexsort((s, late))][:n - (PERCENT * n + 99) // 100 + 1] & ~_KIND
                least = [_mix(s ^ np.uint64(0x51ED27 * (k + 1))).min() & ~_KIND | np.uint64(1 + k) for k in range(MINHASHES)]
                row = np.concatenate([prefix, np.array(least, dtype=np.uint64)])
                tokens.append(row)
                keys.append(np.full(len(row), key, dtype=np.int64))
                central.append(np.where((row & _KIND) > 0, int(1e6 * np.log1p(late).mean()), 0))
            if tokens:
                yield pd.DataFrame({"token": _as_long(np.concatenate(tokens)), "key": np.concatenate(keys), "central": np.concatenate(central)})

    return run


def _heat(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """key, piece, grams: a row for each fragment that the set has n-grams in."""
    for b in batches:
        rows = []
        for text in b["text"]:
            s = shingle_set(text)
            key, piece = set_key(s), (s >> np.uint64(61)).astype(int)
            rows += [(key, p, _as_long(s[piece == p])) for p in np.unique(piece)]
        yield pd.DataFrame(rows, columns=["key", "piece", "grams"])


def _stored_pieces(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The stored pieces of the classes' sets."""
    reps = small(materialize(classes.select(F.col("rep").alias("__rep")).distinct(), "join-reps"))
    return materialize(docs.join(reps, F.col("doc_id") == F.col("__rep"), "left_semi").select("text").mapInPandas(
        _pieces, "key long, piece int, grams array<bigint>").dropDuplicates(["key", "piece"]), "join-pieces")


def _overlaps(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """a, b, overlap of each stored pair: partial counts by fragment, summed. Up to BROADCAST_ROWS pairs go to the pieces,
    more of them meet the pieces by shuffle."""
    x = pieces.select(F.col("key").alias("a"), "piece", F.col("grams").alias("ga"))
    y = pieces.select(F.col("key").alias("b"), "piece", F.col("grams").alias("gb"))
    pairs = few = pairs.select("a", "b")
    if pairs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        few = F.broadcast(pairs)
        y = y.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi")
    part = few.join(x, "a").join(y, ["b", "piece"]).select("a", "b", F.size(F.array_intersect("ga", "gb")).alias("part"))
    return pairs.join(part.groupBy("a", "b").agg(F.sum("part").alias("overlap")), ["a", "b"], "left").select(
        "a", "b", F.coalesce("overlap", F.lit(0)).alias("overlap"))


def _measured(pairs: DataFrame, pieces: DataFrame, sizes: DataFrame) -> DataFrame:
    """a, b, linked, dist (1 - Jaccard) of each pair."""
    na, nb = (sizes.select(F.col("key").alias(c), F.col("n").alias(f"n{c}")) for c in "ab")
    got = _overlaps(pairs, pieces).join(na, "a").join(nb, "b")
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return got.select("a", "b", (100 * F.col("overlap") >= PERCENT * union).alias("linked"),
                      (1 - F.col("overlap") / union).alias("dist"))


def components(edges: DataFrame) -> DataFrame:
    """v, c: the smallest vertex that each vertex of the edges (a, b) reaches. Least labels spread along edges and
    jump to their own labels, until none changes."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.min("a")).alias("c")), "labels")
    while True:
        near = both.join(label, F.col("b") == F.col("v")).groupBy("a").agg(F.min("c").alias("near"))
        step = label.join(near, F.col("v") == F.col("a")).select("v", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        up = step.select(F.col("v").alias("p"), F.col("c").alias("pc"))
        new = materialize(step.join(up, F.col("c") == F.col("p"), "left").select(
            "v", "old", F.least("c", F.coalesce("pc", "c")).alias("c")), "labels")
        label = new.select("v", "c")
        if new.where(F.col("c") != F.col("old")).isEmpty():
            return label


def similar_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included) for every row of ``docs``.

    Two texts link when 100 * shared >= 80 * joint n-grams. Null and empty texts have no n-grams and no links: their component is their own id.
    Rows with equal sets are one class and link with each other; a text that has only null ids links with nothing else and its component is null. Repeated
    rows give repeated results; other columns are dropped; an empty table gives an empty result.
    """
    return text_groups(docs).select("doc_id", "n_shingles", "component_id")


def text_groups(docs: DataFrame) -> DataFrame:
    """similar_groups with text_hash (xxhash64 of the text) and group, which tells linked groups apart even if they share
    a component_id, as texts with one doc_id may; null for a text without n-grams."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))    # pandas rounds long ids beside a null
    first = materialize(hashed.mapInPandas(_digest, "kind int, doc_id string, text_hash long, n long, key long, counts binary"), "join-digests")
    rows = first.where(F.col("kind") == 0).select(F.col("doc_id").cast(kind).alias("doc_id"), "text_hash", "n", "key")
    counts = docs.sparkSession.sparkContext.broadcast(_count_table(first))
    classes = materialize(rows.where(F.col("n") > 0).groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n")), "join-classes")

    # tokens that at least two classes show
    posts = docs.mapInPandas(_postings(counts), "token long, key long, central long").withColumn("kind", F.col("token").bitwiseAND(7))
    shared = materialize(posts.repartition("token").dropDuplicates(["token", "key"]).withColumn(
        "m", F.count(F.lit(1)).over(Window.partitionBy("token"))).where(F.col("m") > 1).select("token", "kind", "key", "central"), "join-shared")
    # candidates for clusters: classes of near size that share MINHASHES / 2 min-hashes with the most central class of each
    heads = shared.where(F.col("kind") > 0).join(classes, "key").select("token", "key", "central", "n")
    best = heads.groupBy("token").agg(F.max(F.struct("central", "key", "n")).alias("hub"))
    rays = heads.join(best, "token").where(
        (F.col("key") != F.col("hub.key")) & (100 * F.least("n", "hub.n") >= PERCENT * F.greatest("n", "hub.n"))).select(
        F.col("key").alias("a"), F.col("hub.key").alias("b")).groupBy("a", "b").count().where(F.col("count") >= MINHASHES // 2).select("a", "b")
    rays = materialize(rays, "join-rays")
    # classes with a class of near size under one of their prefix n-grams
    by_size = Window.partitionBy("token").orderBy("n")
    shown = materialize(shared.where(F.col("kind") == 0).join(classes, "key").withColumns(
        {"under": F.lag("n").over(by_size), "over": F.lead("n").over(by_size)}).where(
        (100 * F.col("under") >= PERCENT * F.col("n")) | (100 * F.col("n") >= PERCENT * F.col("over"))).select(
        "token", "key"), "join-shown")
    rayed = rays.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    about = materialize(rayed.union(shown.select("key")).distinct().join(classes, "key"), "join-about")
    pieces = _stored_pieces(docs, about.join(rayed, "key"))

    # clusters: classes that link with such a hub
    rays = materialize(_measured(rays, pieces, about).where("linked"), "join-linked")
    outer = rays.select(F.col("a").alias("x")).distinct()
    members = (rays.join(outer, F.col("b") == F.col("x"), "left_anti").groupBy(F.col("a").alias("key"))
               .agg(F.min(F.struct("dist", "b")).alias("m")).select("key", F.col("m.b").alias("hub"), F.col("m.dist").alias("dist")))
    placed = materialize(about.join(members, "key", "left").select(
        "key", "n", F.coalesce("hub", "key").alias("hub"), F.coalesce("dist", F.lit(0.0)).alias("dist")), "join-placed")
    radius = placed.groupBy("hub").agg(F.max("dist").alias("r"))

    # candidate pairs of clusters: the prefixes of similar classes share as many n-grams as the shorter remainders leave of the
    # overlap. A cluster shows a token once, with the sizes of the classes behind it and the most tokens that one of them shows
    shows = shown.groupBy("key").agg(F.count(F.lit(1)).alias("shows"))
    shown = shown.join(placed.join(shows, "key"), "key").groupBy("token", "hub").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("shows").alias("shows"))
    x, y = (shown.select("token", F.col("hub").alias(c), *[F.col(k).alias(f"{k}{c}") for k in ("lo", "hi", "shows")]) for c in "ab")
    least = lambda mine, other: PERCENT * (F.col(mine) + F.col(other)) / (100 + PERCENT) - PERCENT * F.col(mine) / 100
    enough = lambda tokens: tokens + 1e-6 >= F.least(least("hia", "lob"), least("hib", "loa"))
    near = (x.join(y, "token").where((F.col("a") < F.col("b")) & (100 * F.col("hia") >= PERCENT * F.col("lob"))
                                     & (100 * F.col("hib") >= PERCENT * F.col("loa")) & enough(F.least("showsa", "showsb")))
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("tokens"), F.min("loa").alias("loa"), F.max("hia").alias("hia"),
                                   F.min("lob").alias("lob"), F.max("hib").alias("hib"))
            .where(enough(F.col("tokens"))).select("a", "b"))
    near = materialize(near, "join-near")
    more = near.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(rayed, "key", "left_anti")
    pieces = pieces.union(_stored_pieces(docs, about.join(more, "key")))
    limit = 1 - PERCENT / 100 + 1e-9
    ra, rb = (radius.select(F.col("hub").alias(c), F.col("r").alias(f"r{c}")) for c in "ab")
    hubs = materialize(_measured(near, pieces, about).join(ra, "a").join(rb, "b").where(
        F.col("linked") | (F.col("dist") <= limit + F.col("ra") + F.col("rb"))), "join-hubs")
    edges = [rays.select("a", "b"), hubs.where("linked").select("a", "b")]
    doubt = hubs.where(~F.col("linked") & (F.col("ra") + F.col("rb") > 0)).select("a", "b")
    if not doubt.isEmpty():
        doubt = materialize(_apart(doubt, components(edges[0].union(edges[1]))), "join-doubt")
        edges += _member_links(doubt, placed, pieces, about)
    links = edges[0]
    for e in edges[1:]:
        links = links.union(e)
    label = components(links)
    named = classes.join(label, F.col("key") == F.col("v"), "left").select("key", "rep", F.coalesce("c", "key").alias("c"))
    least = named.where(F.col("c") != F.col("key")).select("c").distinct().join(named, "c").groupBy("c").agg(F.min("rep").alias("least"))
    named = named.join(least, "c", "left").select("key", F.col("c").alias("group"), F.coalesce("least", "rep").alias("component_id"))
    return (rows.where(F.col("n") > 0).join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "group")
            .union(rows.where(F.col("n") == 0).select("doc_id", "n", "doc_id", "text_hash", F.lit(None).cast("long"))))


def _deltas(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """ref, key, delta: the n-grams that only one of the two sets has, a row for each fragment with any."""
    none = F.array().cast("array<bigint>")
    own = pieces.select("key", "piece", F.col("grams").alias("own"))
    base = pieces.select(F.col("key").alias("ref"), "piece", F.col("grams").alias("base"))
    both = (rows.select("ref", "key", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("piece"))
            .join(own, ["key", "piece"], "left").join(base, ["ref", "piece"], "left")
            .withColumns({"own": F.coalesce("own", none), "base": F.coalesce("base", none)}))
    return both.select("ref", "key", F.concat(F.array_except("own", "base"), F.array_except("base", "own")).alias("delta")).where(
        F.size("delta") > 0)


def _member_links(doubt: DataFrame, placed: DataFrame, pieces: DataFrame, sizes: DataFrame) -> list[DataFrame]:
    """Links (a, b) between the members of pairs of clusters whose hubs don't link, as frames.

    Every class is written as its difference to one hub of the pair, that of the larger cluster; two classes differ by the
    symmetric difference of their differences. An outsider y that doesn't link with the hub has a large one, so that a member m
    can link with it only if it shares over (s + (hub's size - m's size) * (100 - PERCENT) / (100 + PERCENT)) / 2 of m's s
    differing n-grams. Hence y has one of any s - that + 1 of them; those that fewest outsiders have are looked up.
    """
    size = placed.groupBy("hub").agg(F.count(F.lit(1)).alias("size"))
    sa, sb = (size.select(F.col("hub").alias(c), F.col("size").alias(f"s{c}")) for c in "ab")
    first = F.struct("sa", "a") > F.struct("sb", "b")
    turned = doubt.join(sa, "a").join(sb, "b").select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("ref"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("other"))
    inside = (turned.select("ref").distinct().join(placed.select(F.col("hub").alias("ref"), "key", "n"), "ref")
              .where(F.col("key") != F.col("ref")).select("ref", "key", "n", F.lit(False).alias("outer")))
    outside = turned.join(placed.select(F.col("hub").alias("other"), "key", "n"), "other").select("ref", "key", "n", F.lit(True).alias("outer"))
    rows = materialize(inside.union(outside), "join-rows")
    delta = materialize(_deltas(rows, pieces), "join-deltas")
    hub = placed.where(F.col("key") == F.col("hub")).select(F.col("key").alias("ref"), F.col("n").alias("nh"))
    known = (rows.join(delta.groupBy("ref", "key").agg(F.sum(F.size("delta")).alias("s")), ["ref", "key"]).join(hub, "ref"))
    less, more = 100 - PERCENT, 100 + PERCENT
    linked = more * F.col("s") <= less * (F.col("n") + F.col("nh"))
    known = materialize(known.select("ref", "key", "outer", "s", (F.col("outer") & linked).alias("linked"), (
        F.col("s") - F.floor((more * F.col("s") + less * (F.col("nh") - F.col("n"))) / (2 * more))).alias("tries")), "join-known")
    grams = delta.join(known, ["ref", "key"]).where(~F.col("linked")).select(
        "ref", "key", "outer", "s", "tries", F.explode("delta").alias("gram"))
    out = materialize(grams.where("outer").select("ref", F.col("key").alias("b"), "gram"), "join-outside")
    held = out.groupBy("ref", "gram").agg(F.count(F.lit(1)).alias("held"))
    own = Window.partitionBy("ref", "key")
    tried = grams.where(~F.col("outer")).join(held, ["ref", "gram"]).withColumns(
        {"turn": F.row_number().over(own.orderBy("held", "gram")), "met": F.count(F.lit(1)).over(own)}).where(
        F.col("turn") <= F.col("tries") - (F.col("s") - F.col("met"))).select("ref", F.col("key").alias("a"), "gram")
    pairs = materialize(tried.join(out, ["ref", "gram"]).select("a", "b").distinct(), "join-tried")
    return [known.where("linked").select(F.col("key").alias("a"), F.col("ref").alias("b")),
            materialize(_measured(pairs, pieces, sizes).where("linked"), "join-found").select("a", "b")]


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) that the labels don't place together."""
    ca, cb = (label.select(F.col("v").alias(k), F.col("c").alias(f"c{k}")) for k in "ab")
    return (pairs.join(ca, "a", "left").join(cb, "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(w[i:i + {N - 1}], 'string_agg', ' ') AS gram
      FROM d, unnest(range(1, greatest(len(w) - {N - 2}, 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= {PERCENT} * (x.n + y.n - shared)),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON d.doc_id = c.doc_id
"""
