"""Secret scan with a random forest against false positives, with DataFrame, SQL and MLlib (JVM) operations only.

Candidates are long runs of key-like characters. Each has features of its length, its character transitions, how far
dictionary trigrams cover it, the path it comes from and its neighbouring words. A random forest trained from labelled
findings scores all of them. Tables that features look up (trigrams, neighbours) have a fixed number of slots.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.operators.materialize import materialize

LEAST = 16                          # characters of a candidate
CANDIDATE = r"([A-Za-z0-9_/+=\-]{16,})"
KEYLIKE = r"[A-Za-z0-9_/+\-]{16,}+"
# Each match in a word: what is named before "=" or ":" (group 1) and a run of key-like characters with its padding (group 2).
# A run that only reaches the length with "=" inside is whole. Nothing here steps back over a run, so long words cost no more.
MATCHES = (r"""(?:(?<![A-Za-z0-9_/+.\-])([A-Za-z0-9_/+.\-]++)[\\"']*+[=:]++[\\"']*+(?=[A-Za-z0-9_/+\-]{16}))?+"""
           r"(" + KEYLIKE + r"(?:=++(?![A-Za-z0-9_/+\-]))?+"
           r"|(?<![A-Za-z0-9_/+=\-])(?![A-Za-z0-9_/+=\-]*?[A-Za-z0-9_/+\-]{16})[A-Za-z0-9_/+=\-]{16,}+)")
TRIGRAMS, NEIGHBOURS = 1 << 14, 1 << 10
COMMON = 1e-7                       # share of all trigrams above which a slot counts as covered
FEATURES = ["length", "switches", "digits", "uppers", "variety", "coverage", "transition", "slashes", "tame_path", "near"]
# Path words that announce made-up content.
TAME = "test|example|sample|fixture|mock|doc"
# Fixed values, used to label findings where no labels are given: key formats that are known by their prefix; what a key without
# one looks like; and the words that name a secret beside it. The same string beside "commit" or "sha" is none.
PREFIXED = r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[baprs]-[A-Za-z0-9-]{10,}"
PLAIN = r"[0-9a-f]{16,}|[0-9A-F]{16,}"
NAMED = "key|secret|token|passw|credential"


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(id, path, pos, match, candidate, near): every candidate with the word number, its number in the word, and its name
    and up to three neighbouring words."""
    words = F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")
    rows = docs.select(F.col(key).alias("id"), F.col(path).cast("string").alias("path"), words.alias("w"))
    found = F.filter(F.transform("w", lambda x, i: F.when(
        (F.length(x) >= LEAST) & x.rlike(CANDIDATE), F.struct(i.alias("pos"), x.alias("word")))), lambda x: x.isNotNull())
    # Only the words at and around a candidate leave the row.
    near = F.transform(found, lambda f: F.struct(
        f["pos"].alias("pos"), f["word"].alias("word"),
        F.array(F.coalesce(F.get("w", f["pos"] - 1), F.lit("")), F.coalesce(F.get("w", f["pos"] - 2), F.lit("")),
                F.coalesce(F.get("w", f["pos"] + 1), F.lit(""))).alias("around")))
    one = rows.select("id", "path", F.explode(near).alias("f")).select("id", "path", "f.pos", "f.word", "f.around")
    # "name=value": the name is a neighbour, the value the candidate; a name as long as a key is a candidate too.
    before, value = (F.regexp_extract_all("word", F.lit(MATCHES), F.lit(i)) for i in (1, 2))
    each = F.flatten(F.zip_with(before, value, lambda b, v: F.concat(
        F.transform(F.regexp_extract_all(b, F.lit(KEYLIKE), F.lit(0)), lambda x: F.struct(x.alias("value"), F.lit("").alias("name"))),
        F.array(F.struct(v.alias("value"), F.regexp_extract(b, r"(?<![A-Za-z0-9_.\-])[0-9.\-]*+([A-Za-z_][A-Za-z0-9_.\-]*+)$", 1).alias("name"))))))
    one = one.select("id", "path", "pos", "around", F.posexplode(each).alias("match", "c"))
    near = F.transform(F.concat(F.array("c.name"), "around"), lambda w: ascii_lower(F.regexp_replace(w, r"[^A-Za-z0-9=:]", "")))
    return one.select("id", "path", "pos", "match", F.col("c.value").alias("candidate"), near.alias("near"))


def _trigrams(word: Column) -> Column:
    """Overlapping trigrams of a word (a shorter word itself): three passes of whole steps, each linear in the length."""
    w = ascii_lower(word)
    steps = [F.regexp_extract_all(F.substring(w, F.lit(at), F.length(w)), F.lit("(?s)(.{3})"), 1) for at in (1, 2, 3)]
    return F.when(F.length(w) < 3, F.array(w)).otherwise(F.concat(*steps))


def _slot(x: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(x), F.lit(slots)).cast("int")


def _table(values: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps([round(v, 5) for v in values])), "array<double>")


def dictionary(docs: DataFrame, text: str = "text") -> list[float]:
    """Hashed letter trigrams of the ordinary words (4 to 12 letters) of all documents: ``TRIGRAMS`` slots with the logarithm of
    1 + the slot's share of all trigrams in units of ``COMMON``; 0: unseen.
    """
    words = docs.select(F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"\b(\p{L}{4,12})\b"), 1)).alias("w"))
    # Each distinct word is cut into trigrams once.
    words = words.groupBy("w").agg(F.count("*").alias("n"))
    rows = words.select("n", F.explode(_trigrams(F.col("w"))).alias("g")).groupBy(_slot(F.col("g"), TRIGRAMS).alias("s")) \
        .agg(F.sum("n").alias("n")).collect()
    out, total = [0.0] * TRIGRAMS, sum(r["n"] for r in rows)
    for r in rows:
        out[r["s"]] = math.log(1 + r["n"] / total / COMMON)
    return out


def neighbour_odds(labelled: DataFrame) -> list[float]:
    """Smoothed log odds of a finding being real per hashed neighbouring word, ``NEIGHBOURS`` slots."""
    rows = labelled.select("label", F.explode(F.array_distinct("near")).alias("w")).where("w != ''") \
        .groupBy(_slot(F.col("w"), NEIGHBOURS).alias("s")).agg(F.sum("label").alias("a"), F.count("*").alias("n")).collect()
    out = [0.0] * NEIGHBOURS
    for r in rows:
        out[r["s"]] = math.log((r["a"] + 0.5) / (r["n"] - r["a"] + 0.5))
    return out


def featured(found: DataFrame, trigrams: list[float], odds: list[float]) -> DataFrame:
    c = F.col("candidate")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "l"), "[A-Z]", "U"),
                                                "[0-9]", "d"), "[^lUd]", "-")
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    size = F.length(c).cast("double")
    table, near = _table(trigrams), _table(odds)
    seen = F.transform(_trigrams(c), lambda g: F.get(table, _slot(g, TRIGRAMS)))
    odd = F.transform(F.filter("near", lambda w: w != ""), lambda w: F.get(near, _slot(w, NEIGHBOURS)))
    f = found.withColumn("_seen", F.transform(F.array(seen), lambda s: F.struct(
        (F.size(F.filter(s, lambda x: x > math.log(2))) / F.size(s)).alias("coverage"),
        (F.aggregate(s, F.lit(0.0), lambda a, x: a + x) / F.size(s)).alias("transition")))[0])
    return f.select(
        "*", size.alias("length"), ((runs - 1) / size).alias("switches"),
        (F.length(F.regexp_replace(c, "[^0-9]", "")) / size).alias("digits"),
        (F.length(F.regexp_replace(c, "[^A-Z]", "")) / size).alias("uppers"),
        (F.size(F.array_distinct(F.split(c, ""))) / size).alias("variety"),
        F.col("_seen.coverage").alias("coverage"), F.col("_seen.transition").alias("transition"),
        F.length(F.regexp_replace(c, "[^/]", "")).cast("double").alias("slashes"),
        F.coalesce(ascii_lower(F.col("path")).rlike(TAME), F.lit(False)).cast("double").alias("tame_path"),
        F.aggregate(odd, F.lit(0.0), lambda a, x: a + x).alias("near_odds")) \
        .drop("_seen").withColumnRenamed("near", "near_words").withColumnRenamed("near_odds", "near")


def format_labels(found: DataFrame) -> DataFrame:
    """Label 1 where the whole candidate has a prefixed key format, or is plain hexadecimal beside a word that names a secret."""
    c = F.col("candidate")
    named = F.exists("near", lambda w: w.rlike(NAMED))
    return found.withColumn("label", (c.rlike(f"^(?:{PREFIXED})$") | (c.rlike(f"^(?:{PLAIN})$") & named)).cast("int"))


class SecretModel:
    """Lookup tables and forest; ``forest`` is None if the labelled findings hold one class only."""

    def __init__(self, trigrams: list[float], odds: list[float], forest: RandomForestClassificationModel | None, only: float):
        self.trigrams, self.odds, self.forest, self.only = trigrams, odds, forest, only

    def score(self, found: DataFrame) -> DataFrame:
        """``found`` with ``score``, the forest's probability that a finding is real."""
        if self.forest is None:
            return found.withColumn("score", F.lit(self.only))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(featured(found, self.trigrams, self.odds))
        out = self.forest.transform(rows).withColumn("score", vector_to_array("_p")[1])
        return out.withColumnRenamed("near", "near_odds").withColumnRenamed("near_words", "near").select(*found.columns, "score")


def train(labelled: DataFrame, trigrams: list[float], max_findings: int = 20_000, trees: int = 20, depth: int = 6) -> SecretModel:
    """Fit on labelled findings (the columns of :func:`findings` and ``label`` 0 / 1).

    Sample bound: about ``max_findings`` of each label, by a hash of document, position, match and candidate.
    """
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    u = F.pmod(F.xxhash64("id", "pos", "match", "candidate"), F.lit(1 << 20))
    take = F.lit(False)
    for label, n in sizes.items():
        if label in (0, 1):
            take = take | ((F.col("label") == label) & (u < int((1 << 20) * min(1.0, max_findings / n))))
    if not (sizes.get(0) and sizes.get(1)):
        return SecretModel(trigrams, [], None, 1.0 if sizes.get(1) else 0.0)
    # A bounded sample in one sorted partition: the forest is the same at every run.
    sample = materialize(labelled.where(take).repartition(1).sortWithinPartitions("id", "pos", "match", "candidate"), "findings")
    odds = neighbour_odds(sample)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(featured(sample, trigrams, odds))
    forest = RandomForestClassifier(featuresCol="_x", labelCol="label", probabilityCol="_p", rawPredictionCol="_r",
                                    predictionCol="_y", numTrees=trees, maxDepth=depth, seed=5)
    return SecretModel(trigrams, odds, forest.fit(rows), 0.0)


def scan(docs: DataFrame, model: SecretModel, key: str = "doc_id", text: str = "text", path: str = "source",
         threshold: float = 0.5) -> DataFrame:
    """One row per candidate: ``key``, ``pos`` (word number from 0), ``match`` (number in the word from 0),
    ``candidate``, ``score``, ``predicted``.

    Null, empty and wordless texts have no candidates; a null path is ordinary; null ids and repeated rows give their
    findings like any other row; an empty table gives none; columns other than the three named are ignored.
    """
    return judged(findings(docs, key, text, path), model, key, threshold)


def judged(found: DataFrame, model: SecretModel, key: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """The rows of :func:`scan` from findings that are there already."""
    s = model.score(found)
    return s.select(F.col("id").alias(key), "pos", "match", "candidate", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op4(docs: DataFrame) -> DataFrame:
    """The documents carry no finding labels, so key formats label the training fold (four fifths of the ids).

    The findings are extracted once and written; sizes, sample and scan read them.
    """
    trigrams = dictionary(docs)
    found = materialize(findings(docs), "all_findings")
    fold = F.coalesce(F.crc32(F.col("id").cast("string")) % 5 != 0, F.lit(False))
    model = train(format_labels(found).where(fold), trigrams)
    return judged(found, model)
