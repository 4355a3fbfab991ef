"""Secret scans (6): a random forest that tells secrets from other opaque strings.

Candidates are runs of at least LEAST key characters with a digit in them, and, whatever their length and characters, all values assigned to a
credential's name, keys of an issuer's shape, passwords in addresses and blocks of private keys. A forest on their length, character
classes and transitions, dictionary coverage, path (the document's source) and neighbouring words is trained on labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waka.llm.common import WORD, let, materialize, read, words

LEAST = 12             # characters
SAMPLE = 20_000        # labelled findings of each class that the forest is trained on, at most: those with the least hash
DICTIONARY = 2_000     # commonest words of three letters or more
TREES, DEPTH = 24, 7
PATHS = 8              # classes of paths (by hash)
_CLASSES = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "other": "[^A-Za-z0-9]"}
THRESHOLD = 0.5
_RUN = rf"([A-Za-z0-9_+/=\-]{{{LEAST},}})"
# Words that announce a credential, and the shapes that label findings.
CUES = "secret|token|passw|pwd|api_?key|apikey|access|auth|bearer|credential"
SHAPES = [r"^AKIA[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36}$", r"^sk_(live|test)_[A-Za-z0-9]{16,}$", r"^xox[abp]-[A-Za-z0-9-]{10,}$"]
_SHAPED = "|".join(x.strip("^$").replace("(live", "(?:live") for x in SHAPES)
_BLOCK = "-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"
_NAME = rf"(?i:{CUES.replace('auth', 'auth(?!ors?(?![a-z]))')})\w*[\"'\])]*[ \t]*(?:=>|:=|==?|:)[ \t]*"
_ADDRESS = r"://[^\s:/@]+:(?=[^\s:/@]+@)"
# What announces a value, then the value: a credential's name and what is assigned to it, quoted or up to the next white space or quote;
# an address up to its password; nothing before a key block or an issuer's shape.
ASSIGNED = (rf"({_NAME}|{_ADDRESS}|(?=-----BEGIN [A-Z ]*PRIVATE KEY)|(?<![A-Za-z0-9_])(?=(?:{_SHAPED})(?![A-Za-z0-9_])))"
            rf"({_BLOCK}|(?<=://[^\s:/@]{{1,99}}:)[^\s:/@]+(?=@)|(?:{_SHAPED})(?![A-Za-z0-9_])|\"[^\"\r\n]+\"|'[^'\r\n]+'|[^\s\"']+)")
_MARK = "\uE000"        # stands before such a value while its word is counted


def assigned(docs: DataFrame) -> DataFrame:
    """As candidates: the announced values, but those that are a run of key characters and found as such."""
    text = F.translate(F.coalesce("text", F.lit("")), _MARK, "")
    some = docs.where(F.col("text").rlike(ASSIGNED)).select(
        "doc_id", "source", F.regexp_extract_all(text, F.lit(ASSIGNED), F.lit(1)).alias("names"),
        F.regexp_extract_all(text, F.lit(ASSIGNED), F.lit(2)).alias("values"),
        words(F.regexp_replace(text, F.lit(ASSIGNED), F.lit(f"$1{_MARK}$2")), WORD).alias("w"))
    # the words that hold a mark, once for each: the n-th mark is that of the n-th value
    at = F.flatten(F.transform("w", lambda x, i: F.transform(
        F.filter(F.split(x, ""), lambda c: c == _MARK), lambda _, k: F.struct(i.cast("long").alias("at"), k.alias("k"), F.get("w", i + 1).alias("n1")))))
    marked = F.filter("w", lambda x: x.contains(_MARK))
    rows = some.where(F.size(marked) > 0).select("doc_id", "source", F.explode(F.arrays_zip("names", "values", at.alias("at"))).alias("h"))
    bare = F.regexp_replace("h.values", r"^[\"']|[\"',;]+$", "")
    rows = rows.select("doc_id", "source", F.col("h.at.at").alias("at_word"), (-1 - F.col("h.at.k")).alias("place"), bare.alias("finding"),
                       F.concat("h.names", F.regexp_extract("h.values", r"^([\"']?)", 1)).alias("left"), F.coalesce("h.at.n1", F.lit("")).alias("right"))
    run = F.col("finding").rlike(r"^[A-Za-z0-9_+/\-]+=*$") & (F.length("finding") >= LEAST) & F.col("finding").rlike("[0-9]")
    return rows.where((F.col("finding") != "") & ~run)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, source, at_word, place, finding, left and right context: one row for each candidate of each text.

    ``place`` counts the runs of a word from 0, and the assigned values that aren't runs from -1 downwards."""
    return runs(docs).unionByName(assigned(docs))


def runs(docs: DataFrame) -> DataFrame:
    """As candidates: runs of key characters with a digit in them."""
    w = words(F.col("text"), WORD)
    run = F.lit(_RUN)

    def found(v: Column) -> Column:
        some = F.filter(F.transform(v, lambda x, i: F.when(F.length(x) >= LEAST, F.struct(x.alias("x"), i.alias("i")))),
                        lambda h: h.isNotNull() & h["x"].rlike("[0-9]") & h["x"].rlike(_RUN))
        return F.transform(some, lambda h: F.struct(
            h["i"].alias("at"), h["x"].alias("word"), F.get(v, h["i"] - 1).alias("p1"), F.get(v, h["i"] - 2).alias("p2"),
            F.get(v, h["i"] + 1).alias("n1"), F.regexp_extract_all(h["x"], run, F.lit(1)).alias("runs")))

    rows = docs.select("doc_id", "source", F.explode(let(w, found)).alias("h")).select("*", F.posexplode("h.runs").alias("place", "run"))
    # what stands before a "=" inside the run belongs to its left context
    value = F.regexp_extract("run", r"([^=]{6,}=*)$", 1)
    return (rows.withColumn("finding", F.when(F.length(value) >= LEAST, value).otherwise(F.col("run")))
            .where(F.col("finding").rlike("[0-9]"))
            .select("doc_id", "source", F.col("h.at").cast("long").alias("at_word"), "place", "finding",
                    F.concat_ws(" ", "h.p2", "h.p1", F.regexp_extract("h.word", r"^(.*?)[^=:]*$", 1)).alias("left"),
                    F.coalesce("h.n1", F.lit("")).alias("right")))


def common_words(docs: DataFrame, n: int = DICTIONARY) -> list[str]:
    """The n commonest lower-case words of the corpus (a word at the end of a sentence aside): the bounded dictionary."""
    some = docs.select(F.explode(words(F.col("text"), r"(?<!\S)[\p{Ll}]{3,12}(?!\S)")).alias("w")).groupBy("w").count()
    return sorted(r["w"] for r in some.orderBy(F.desc("count"), "w").limit(n).collect())


def features(found: DataFrame, dictionary: list[str]) -> tuple[DataFrame, list[str]]:
    f = F.col("finding")
    n = F.length(f).cast("double")
    share = lambda pattern: F.regexp_count(f, F.lit(pattern)) / n
    letters = F.regexp_extract_all(F.lower(f), F.lit("[a-z]{3,}"), F.lit(0))
    known = F.array(*map(F.lit, dictionary)) if dictionary else F.array().cast("array<string>")
    covered = F.aggregate(F.array_intersect(letters, known), F.lit(0), lambda a, x: a + F.length(x)) / n
    own = {
        "f_length": n, "f_digit": share("[0-9]"), "f_upper": share("[A-Z]"), "f_lower": share("[a-z]"),
        "f_hex": share("[0-9a-f]"), "f_mark": share(r"[_+/=\-]"),
        **{f"f_turn_{a}_{b}": share(f"(?<={x})(?={y})") for a, x in _CLASSES.items() for b, y in _CLASSES.items() if a != b},
        "f_distinct": F.size(F.array_distinct(F.split(f, ""))) / n,
        "f_covered": covered,
        "f_vowel": share("[aeiouAEIOU]"),
        **{f"f_path_{k}": (F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(PATHS)) == k).cast("double") for k in range(PATHS)},
        "f_cue": F.lower("left").rlike(CUES).cast("double"),
        "f_assigned": F.col("left").rlike("[=:]").cast("double"),
        "f_quoted": F.col("left").rlike("[\"']").cast("double"),
        "f_address": F.col("left").rlike(r"://[^\s:/@]+:$").cast("double"),
        "f_right": F.length("right").cast("double"),
        "f_left_known": F.arrays_overlap(F.regexp_extract_all(F.lower("left"), F.lit(r"[\p{Ll}]{3,12}"), F.lit(0)), known).cast("double"),
        "f_right_known": F.array_contains(known, F.lower(F.regexp_replace("right", r"[^\p{L}]", ""))).cast("double"),
    }
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in own.items()}), list(own)


def label_findings(found: DataFrame) -> DataFrame:
    """Findings labelled from their issuer's shape, their place in an address, a key block or an assignment to a credential's name: the labels at hand where no one has judged findings."""
    known = F.col("left").rlike(r"://[^\s:/@]+:$") | F.col("finding").startswith("-----BEGIN")
    for s in SHAPES:
        known = known | F.col("finding").rlike(s)
    named = F.lower("left").rlike(rf"({CUES})\w*\W*[=:]\W*$") & ~F.col("finding").rlike("^[0-9-]+$")
    if "f_covered" in found.columns:      # an assigned common word, such as "token: the"
        named = named & ((F.col("f_covered") < 1) | (F.col("f_quoted") > 0))
    return found.withColumn("label", (known | named).cast("double"))


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, source, at_word, place, finding, score and secret (score >= THRESHOLD) of every candidate.

    ``labelled``: findings with a column label (1 secret, 0 not); without it, label_findings labels those of ``docs``. Null and empty texts have no candidates;
    repeated rows give repeated findings; if all labels agree, so do all scores. Other columns are dropped.
    """
    docs = docs.select("doc_id", "source", "text")
    found = materialize(candidates(docs), "secret-candidates")
    dictionary = common_words(docs)
    ready, names = features(found, dictionary)
    given = features(labelled, dictionary)[0] if labelled is not None else label_findings(ready)
    order = F.xxhash64("finding", "left", "doc_id", "at_word", "place")
    given = materialize(given.where(F.col("label").isNotNull()).select("label", *names, order.alias("__o"), "finding"), "secret-labelled")
    held = {r["label"]: r["count"] for r in given.groupBy("label").count().collect()}
    kinds = sorted(held)
    out = ["doc_id", "source", "at_word", "place", "finding"]
    if len(kinds) < 2:
        return ready.select(*out, F.lit(kinds[0] if kinds else 0.0).alias("score"), F.lit(bool(kinds and kinds[0])).alias("secret"))
    parts = [given.where(F.col("label") == k).orderBy("__o", "finding").limit(SAMPLE)
             .select("label", *names, F.lit(n / min(n, SAMPLE)).alias("__weight")) for k, n in sorted(held.items())]
    some = materialize(parts[0].unionByName(parts[1]), "secret-sample")
    vector = VectorAssembler(inputCols=names, outputCol="__x")
    forest = RandomForestClassifier(featuresCol="__x", labelCol="label", weightCol="__weight", numTrees=TREES, maxDepth=DEPTH, seed=3,
                                    predictionCol="__p", probabilityCol="__q", rawPredictionCol="__r").fit(vector.transform(some))
    judged = forest.transform(vector.transform(ready))
    return judged.withColumn("score", F.get(vector_to_array("__q"), F.lit(1))).select(*out, "score", (F.col("score") >= THRESHOLD).alias("secret"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
