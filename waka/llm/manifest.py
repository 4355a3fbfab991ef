"""Merkle manifest (13): a recursive-CTE climb over stored, parent-linked nodes.

Each row is a leaf; every FAN consecutive nodes of a language become one node of the next level until one, the
language's subroot, remains, and the subroots are joined the same way into the root. Each level is built once and stored as
node rows that name their parent and carry their siblings. A recursive query then ascends from the leaves: it
appends the siblings of each node it passes and folds the digest up to the root. The leaves of one run share all that
stands above them, so one row climbs for a run, with a fold for each of its leaves and one list of siblings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import CRC_TABLE, LOWER, UPPER, ascii_lower, crc_sql, materialize, number_rows, read, small

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1               # the tree of the subroots
KEY = ("tree", "level", "idx")
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def digest(text: Column) -> Column:
    """H, as its 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf_digest(docs: DataFrame, text: Column) -> Column:
    return digest(F.concat(*[field(text if c == "text" else docs[c]) for c in FIELDS]))


def tampered(doc_id: Column) -> Column:
    """Rows whose text is altered for the proof: 3 divides the crc32 of the decimal id. Rows without an id are left alone."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, idx, n (leaves of the tree), doc_id, leaf and altered, stored; trees number the languages from 0, null first."""
    own = docs.select(*FIELDS)
    text = F.when(tampered(own["doc_id"]), ascii_lower(own["text"])).otherwise(own["text"])
    hashed = materialize(own.select("lang", "doc_id", leaf_digest(own, own["text"]).alias("leaf"),
                                    leaf_digest(own, text).alias("altered")), "manifest-leaves")
    placed = number_rows(hashed, F.col("lang"), F.col("doc_id"), F.col("leaf"), name="no")
    trees = placed.groupBy("lang").agg(F.min("no").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = number_rows(trees, F.col("first"), name="tree").withColumnRenamed("lang", "name")
    return materialize(
        placed.join(small(materialize(trees, "manifest-trees")), F.col("lang").eqNullSafe(F.col("name")))
        .select("tree", (F.col("no") - F.col("first")).alias("idx"), "n", "doc_id", "leaf", "altered"), "manifest-placed")


def runs(nodes: DataFrame, *carried: str) -> DataFrame:
    """The runs of nodes (tree, idx, n, digest) of trees with several: tree, idx, n of the parent, and its children in order."""
    kid = F.struct("idx", *carried)
    return (nodes.where(F.col("n") > 1).groupBy("tree", F.expr(f"idx div {FAN}").alias("up"))
            .agg(F.sort_array(F.collect_list(kid)).alias("kids"), F.first("n").alias("n"))      # FAN children at most
            .select("tree", F.col("up").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), "kids"))


def joined(kids: Column, name: str, but: Column | None = None) -> Column:
    """The digests of a run's children one after the other, all or all but one, as hex text."""
    texts = F.transform(kids, lambda k: hexed(k[name])) if but is None else F.filter(
        F.transform(kids, lambda k, i: F.when(i != but, hexed(k[name]))), lambda x: x.isNotNull())
    return F.array_join(texts, "")


def levels_above(low: DataFrame, tree_size: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored runs of each level, lowest first, and the topmost node of each tree. ``low``: tree, idx, n, digest of level 0."""
    found, tops = [], []
    level, nodes = 0, low
    while True:
        tops.append(nodes.where(F.col("n") == 1).select("tree", F.lit(level).alias("level"), "digest"))
        if tree_size <= 1:
            return found, reduce(DataFrame.unionByName, tops)
        run = materialize(runs(nodes, "digest"), "manifest-level")
        found.append(run)
        nodes = run.select("tree", "idx", "n", digest(joined(F.col("kids"), "digest")).alias("digest"))
        level, tree_size = level + 1, -(-tree_size // FAN)


def linked(run: DataFrame, level: int) -> DataFrame:
    """Node rows of a level from its stored runs: key, parent's key, the siblings before and after."""
    kids, place = F.col("kids"), F.col("place")
    part = lambda start, n: F.unhex(F.array_join(F.transform(F.slice(kids, start, n), lambda k: hexed(k["digest"])), ""))
    return (run.select("tree", F.col("idx").alias("up_idx"), "kids", F.posexplode("kids").alias("place", "kid"))
            .select("tree", F.lit(level).alias("level"), F.col("kid.idx").alias("idx"), F.col("tree").alias("up_tree"),
                    F.lit(level + 1).alias("up_level"), "up_idx", part(F.lit(1), place).alias("before"),
                    part(place + 2, F.size(kids) - place - 1).alias("after")))


def manifest(low: DataFrame) -> tuple[DataFrame, DataFrame, dict] | None:
    """From stored leaves: the parent-linked node rows of all levels above the leaves (the root has none), the subroots (tree, level,
    digest) and the root (key and digest). None for an empty table."""
    most = low.agg(F.max("n"), F.max("tree")).first()
    if most[0] is None:
        return None
    level, subroots = levels_above(low.select("tree", "idx", "n", F.col("leaf").alias("digest")), most[0])
    subroots = materialize(subroots, "manifest-subroots")
    n_trees = most[1] + 1
    crown, top = levels_above(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"),
                                              F.lit(n_trees).cast("long").alias("n"), "digest"), n_trees)
    rows = [linked(run, k) for k, run in enumerate(level) if k] + [linked(run, k) for k, run in enumerate(crown) if k]
    if crown:        # the lowest nodes of the crown are the subroots: they keep their own keys
        lowest = linked(crown[0], 0).drop("tree", "level").withColumnRenamed("idx", "tree")
        rows.append(lowest.join(subroots.select("tree", "level"), "tree").withColumn("idx", F.lit(0).cast("long")))
    columns = [*KEY, "up_tree", "up_level", "up_idx", "before", "after"]
    nodes = materialize(reduce(DataFrame.unionByName, [r.select(*columns) for r in rows]), "manifest-nodes") if rows else None
    apex = top.first() if crown else subroots.first()
    return nodes, subroots, {"tree": apex["tree"], "level": apex["level"], "digest": bytes(apex["digest"])}


def climb(starts: DataFrame, nodes: DataFrame | None, root: dict) -> DataFrame:
    """The recursive query. ``starts``: run_tree, run_idx, the key of the node that the folds stand for, and folds; each ascends to the
    root. Returns run_tree, run_idx, folds at the root and proof, the siblings passed, level by level. Stored."""
    if nodes is None:
        return starts.select("run_tree", "run_idx", "folds", F.unhex(F.lit("")).alias("proof"))
    spark = starts.sparkSession
    starts.createOrReplaceTempView("manifest_starts")
    nodes.createOrReplaceTempView("manifest_nodes")
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")          # a row a run and level; Spark's own bound is a million in all
    try:
        return materialize(spark.sql(f"""
            WITH RECURSIVE climb(run_tree, run_idx, tree, level, idx, folds, proof) AS (
              SELECT run_tree, run_idx, tree, level, idx, folds, unhex('') FROM manifest_starts
              UNION ALL
              SELECT c.run_tree, c.run_idx, n.up_tree, n.up_level, n.up_idx,
                     transform(c.folds, f -> unhex(sha2(lower(concat(hex(n.before), hex(f), hex(n.after))), 256))),
                     concat(c.proof, n.before, n.after)
              FROM climb c JOIN manifest_nodes n ON c.tree = n.tree AND c.level = n.level AND c.idx = n.idx)
            SELECT run_tree, run_idx, folds, proof FROM climb
            WHERE tree = {root['tree']} AND level = {root['level']} AND idx = 0"""), "manifest-climb")
    finally:
        spark.conf.set(ROW_LIMIT, limit)
        spark.catalog.dropTempView("manifest_starts")
        spark.catalog.dropTempView("manifest_nodes")


def prove(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    Columns other than FIELDS play no part. Nulls count as ``-``; rows of a null lang form the first tree, rows of a null id
    come first in theirs and are never altered; rows that share an id are ordered by their leaf digests, and equal rows are leaves of
    their own; texts of any length are hashed whole; an empty table gives an empty result.
    """
    low = leaves(docs)
    made = manifest(low)
    if made is None:
        return low.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, "
                                                "root string, proof_sha256 string, folded_root string, verified boolean")
    nodes, subroots, root = made
    kid = F.struct("idx", "doc_id", "leaf", "altered")
    alone = low.where(F.col("n") == 1).select("tree", "idx", F.lit(0).alias("level"), F.array(kid).alias("kids"))
    run = materialize(runs(low, "doc_id", "leaf", "altered").select("tree", "idx", F.lit(1).alias("level"), "kids").unionByName(alone), "manifest-runs")
    kids = F.col("kids")
    swapped = F.transform(kids, lambda k, at: digest(F.array_join(
        F.transform(kids, lambda o, i: hexed(F.when(i == at, o["altered"]).otherwise(o["leaf"]))), "")))
    starts = run.select(F.col("tree").alias("run_tree"), F.col("idx").alias("run_idx"), *KEY,
                        F.when(F.col("level") == 0, F.transform(kids, lambda k: k["altered"])).otherwise(swapped).alias("folds"))
    top = climb(starts, nodes, root).withColumnsRenamed({"run_tree": "t", "run_idx": "i"})
    subs = small(subroots.select(F.col("tree").alias("s"), F.col("digest").alias("subroot")))
    each = (run.join(top, (F.col("tree") == F.col("t")) & (F.col("idx") == F.col("i"))).join(subs, F.col("tree") == F.col("s"))
            .select("kids", "folds", "proof", "subroot", F.posexplode("kids").alias("at", "kid")))
    return each.select(
        "kid.doc_id", hexed(F.col("kid.leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), F.lit(root["digest"].hex()).alias("root"),
        F.sha2(F.concat(joined(kids, "leaf", F.col("at")), hexed(F.col("proof"))), 256).alias("proof_sha256"),
        hexed(F.get("folds", F.col("at"))).alias("folded_root"),
        (F.get("folds", F.col("at")) == F.unhex(F.lit(root["digest"].hex()))).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prove(read(spark, sf_dir, "documents"))


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in [*FIELDS[:-1], text]) + ")"


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT *, row_number() OVER () AS rn, CASE WHEN {crc_sql("doc_id::VARCHAR")} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}')
      ELSE text END AS changed FROM documents, tab),
h AS (SELECT doc_id, rn, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {_leaf_sql("text")} AS leaf, {_leaf_sql("changed")} AS altered FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM h),
lv AS (
  SELECT tree, 0 AS level, idx, leaf AS digest, n FROM l
  UNION ALL
  SELECT tree, level + 1, idx // {FAN}, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + {FAN - 1}) // {FAN}
  FROM lv WHERE n > 1 GROUP BY tree, level, idx // {FAN}),
sub AS (SELECT tree, level, digest, count(*) OVER () AS trees FROM lv WHERE n = 1),
crown AS (
  SELECT 0 AS level, tree AS idx, digest, trees AS n FROM sub
  UNION ALL
  SELECT level + 1, idx // {FAN}, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + {FAN - 1}) // {FAN}
  FROM crown WHERE n > 1 GROUP BY level, idx // {FAN}),
node AS (
  SELECT tree, level, idx, digest, tree AS up_tree, level + 1 AS up_level, idx // {FAN} AS up_idx FROM lv WHERE n > 1
  UNION ALL SELECT tree, level, 0, digest, {TOP}, 1, tree // {FAN} FROM sub WHERE trees > 1
  UNION ALL SELECT {TOP}, level, idx, digest, {TOP}, level + 1, idx // {FAN} FROM crown WHERE n > 1 AND level > 0),
link AS (
  SELECT *, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS ahead,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
  FROM node WINDOW w AS (PARTITION BY up_tree, up_level, up_idx ORDER BY tree, idx)),
climb AS (
  SELECT rn, tree, 0 AS level, idx, altered AS fold, '' AS proof FROM l
  UNION ALL
  SELECT c.rn, k.up_tree, k.up_level, k.up_idx, sha256(k.ahead || c.fold || k.behind), c.proof || k.ahead || k.behind
  FROM climb c JOIN link k ON c.tree = k.tree AND c.level = k.level AND c.idx = k.idx),
top AS (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY length(proof) DESC, tree, level DESC) AS r FROM climb),
root AS (SELECT digest FROM crown WHERE n = 1)
SELECT l.doc_id, l.leaf, sub.digest AS subroot, root.digest AS root, sha256(top.proof) AS proof_sha256, top.fold AS folded_root,
       top.fold = root.digest AS verified
FROM l JOIN sub ON l.tree = sub.tree JOIN top ON l.rn = top.rn AND top.r = 1 CROSS JOIN root
"""
