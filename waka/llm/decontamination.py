"""Benchmark decontamination (2): SimHash of item-sized windows, multi-index Hamming search, exact check.

A window is a run of as many words as a benchmark item. An item's shingles that a document repeats are found first: of all windows whose first
shared shingle is the same, the one that starts there shares most with the item, so these starts are enough, and only
those with as many shared shingles as the similarity needs are windows worth a fingerprint. Window and item
fingerprints within RADIUS bits agree in at least one of RADIUS + 1 blocks, on which they are joined; the survivors are
checked by their weighted Jaccard similarity (shingle counts as weights).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waka.llm.common import BROADCAST_ROWS, ascii_lower, materialize, read, shingles, small, words

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N, PERCENT = 5, 80
BITS = 64
RADIUS = 23      # similarity 0.8 is about 10 bits apart, standard deviation 3


def text_shingles(text: Column) -> Column:
    """Hashes of the five-word shingles in order; words are lower-cased runs of letters and digits, punctuation aside."""
    return shingles(words(ascii_lower(text), PATTERN), N)


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of shingle hashes, each as often as it occurs."""
    half = lambda b: F.aggregate(hashes, F.lit(0), lambda acc, h: acc + F.getbit(h, b).cast("int")) * 2 > F.size(hashes)
    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"),
                       lambda acc, b: acc.bitwiseXOR(F.when(half(b), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(
                           F.lit(0).cast("long"))))


def blocks(fingerprint: Column) -> Column:
    """Array of (block, value): the fingerprint cut into RADIUS + 1 blocks of bits."""
    cuts = [BITS * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftright(fingerprint, lo).bitwiseAND((1 << (hi - lo)) - 1).alias("value"))
                     for i, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))])


def shared_weight(a: Column, b: Column) -> Column:
    """Sum over shingles of the smaller count."""
    times = lambda s, h: F.size(F.filter(s, lambda x: x == h))
    return F.aggregate(F.array_distinct(F.array_intersect(a, b)), F.lit(0), lambda acc, h: acc + F.least(times(a, h), times(b, h)))


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, start_word, n_words, distance, similarity: the best window of each document
    for each item with a weighted Jaccard similarity of at least 0.8 (smallest start on ties).

    A document shorter than an item is one window. Null and empty texts have no windows; items of fewer than five words
    have no shingle that a longer text could repeat and match only a text of the same words; repeated rows give one result; other columns are dropped.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    items = materialize(items.select("item_id", text_shingles(F.col("text")).alias("item")).where(F.size("item") > 0)
                        .withColumns({"span": F.size("item"), "print": simhash(F.col("item"))}), "leak-items")
    known = materialize(items.select("item_id", "span", F.explode("item").alias("hash")).distinct(), "leak-known")
    seen = docs.select("doc_id", "text_hash", text_shingles(F.col("text")).alias("s"))
    hits = (seen.select("doc_id", "text_hash", F.size("s").alias("n"), F.posexplode("s").alias("pos", "hash"))
            .join(small(known), "hash").select("doc_id", "text_hash", "n", "item_id", "span", "pos").distinct())
    # a start is worth a window if the need-th shared shingle from it on is still inside
    turn = Window.partitionBy("doc_id", "text_hash", "item_id").orderBy("pos")
    ranked = materialize(hits.withColumn("turn", F.row_number().over(turn)).withColumn("width", F.least("span", "n")).withColumn(
        "need", F.ceil(F.lit(PERCENT) * (F.col("span") + F.col("width")) / (100 + PERCENT)).cast("int")), "leak-hits")
    then = ranked.select("doc_id", "text_hash", F.col("item_id").alias("of"), F.col("turn").alias("at"), F.col("pos").alias("last"))
    first = ranked.select("doc_id", "text_hash", "n", "item_id", "span", "width", "pos", (F.col("turn") + F.col("need") - 1).alias("until"))
    f, t = first.alias("f"), then.alias("t")
    windows = materialize(
        f.join(t, F.col("f.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("f.text_hash").eqNullSafe(F.col("t.text_hash"))
               & F.col("f.item_id").eqNullSafe(F.col("t.of")) & (F.col("f.until") == F.col("t.at")))
        .where(F.col("last") < F.col("pos") + F.col("span"))
        .select("f.doc_id", "f.text_hash", "span", "width", F.least(F.col("pos"), F.col("n") - F.col("width")).alias("start"))
        .distinct(), "leak-windows")
    few = windows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    by_text = windows.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.collect_list(F.struct("span", "width", "start")).alias("windows"))      # of one text
    by_text = F.broadcast(by_text) if few else by_text
    texts = docs.join(by_text, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("text_hash").eqNullSafe(F.col("__hash")))
    cut = (texts.select("doc_id", "text_hash", "windows", text_shingles(F.col("text")).alias("s"))
           .select("doc_id", "text_hash", "s", F.explode("windows").alias("w"))
           .select("doc_id", "text_hash", "w.span", "w.start", F.slice("s", F.col("w.start") + 1, F.col("w.width")).alias("window"))
           .dropDuplicates(["doc_id", "text_hash", "span", "start"]))
    printed = materialize(cut.withColumn("wprint", simhash(F.col("window"))), "leak-prints")
    index = materialize(items.select("item_id", F.col("span").alias("ispan"), "print", F.explode(blocks(F.col("print"))).alias("key"))
                        .select("item_id", "ispan", "print", "key.block", "key.value"), "leak-index")
    apart = F.bit_count(F.col("wprint").bitwiseXOR(F.col("print")))
    near = (printed.select("doc_id", "text_hash", "span", "start", "wprint", F.explode(blocks(F.col("wprint"))).alias("key"))
            .join(small(index), (F.col("span") == F.col("ispan")) & (F.col("key.block") == F.col("block")) & (F.col("key.value") == F.col("value")))
            .where(apart <= RADIUS).select("doc_id", "text_hash", "span", "start", "item_id", apart.alias("distance")).distinct())
    p, q = printed.select("doc_id", "text_hash", "span", "start", "window").alias("p"), near.alias("q")
    pairs = q.join(p, F.col("p.doc_id").eqNullSafe(F.col("q.doc_id")) & F.col("p.text_hash").eqNullSafe(F.col("q.text_hash"))
                   & (F.col("p.span") == F.col("q.span")) & (F.col("p.start") == F.col("q.start"))).select(
        "q.doc_id", "q.text_hash", "q.span", "q.start", "q.item_id", "distance", "window")
    bodies = small(materialize(items.select(F.col("item_id").alias("__item"), "item").dropDuplicates(["__item", "item"]), "leak-bodies"))
    both = pairs.join(bodies, F.col("item_id").eqNullSafe(F.col("__item"))).withColumn("shared", shared_weight(F.col("window"), F.col("item")))
    joint = F.size("window") + F.size("item") - F.col("shared")
    good = both.where(F.col("shared") * 100 >= joint * PERCENT).withColumn("similarity", F.col("shared") / joint)
    best = good.groupBy("doc_id", "text_hash", "item_id").agg(F.min(F.struct(
        (-F.col("similarity")).alias("far"), F.col("start"), F.col("span"), F.col("distance"))).alias("b"))
    return best.select("doc_id", "text_hash", "item_id", F.col("b.start").cast("long").alias("start_word"),
                       (F.col("b.span") + N - 1).cast("long").alias("n_words"), F.col("b.distance").cast("int").alias("distance"),
                       (-F.col("b.far")).alias("similarity"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_hash")
