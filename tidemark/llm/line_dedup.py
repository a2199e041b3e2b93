"""Line deduplication with DataFrame operations only.

Hashes of the lines long enough are range-partitioned by (hash, document), so a line that a third of all documents
share is spread over many tasks, and a (hash, document) pair never straddles two ranges. Each range reports one row per
hash; the totals of these rows decide which hashes repeat and which document holds the first occurrence (the largest
id). Dropped positions come back as sparse 64-bit words per document: a compressed keep bitmap instead of text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, ascii_lower, fresh
from tidemark.operators.materialize import materialize

NO_ID = -(1 << 63)   # stands for a null id, which thus sorts below every other


def split_lines(text: Column) -> Column:
    """Lines of a text cut at ``\\n``; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _row_id(key: str, text: str) -> list[Column]:
    """Rows of one id and text behave alike, so this pair identifies a row's bitmap."""
    return [F.coalesce(F.col(key), F.lit(NO_ID)).alias("_k"), F.xxhash64(F.col(text)).alias("_t")]


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 40,
                  min_docs: int = 5) -> DataFrame:
    """(_k, _t, drop): per document with drops, a map from word index to the 64-bit word of dropped positions.

    A line's key (stripped, A-Z lower-cased) of at least ``min_length`` code points found in at least ``min_docs``
    documents is dropped in all of them but the one with the largest id. A document is an id: rows that share an id
    count once and, if it is the largest, all keep the line. Null ids count as one lowest document.
    """
    lines = docs.select(*_row_id(key, text), F.posexplode(split_lines(F.col(text))).alias("pos", "line")) \
        .select("_k", "_t", "pos", line_key(F.col("line")).alias("line")) \
        .where(F.length("line") >= min_length) \
        .select("_k", "_t", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"))
    # The range number is stored with the rows: later steps do not depend on how ranges are drawn again after a loss.
    ranged = materialize(lines.repartitionByRange("h", "h2", "_k").sortWithinPartitions("h", "h2", F.desc("_k"), "pos")
                         .withColumn("range", F.spark_partition_id()), "lines")
    per_range = ranged.groupBy("range", "h", "h2").agg(F.count_distinct("_k").alias("n"), F.max("_k").alias("first"))
    per_range = materialize(per_range, "line_ranges")
    repeated = per_range.groupBy("h", "h2").agg(F.sum("n").alias("n"), F.max("first").alias("first")) \
        .where(F.col("n") >= min_docs).select("h", "h2", "first")
    decided = per_range.select("range", "h", "h2").join(repeated, ["h", "h2"])
    gone = ranged.join(decided, ["range", "h", "h2"]).where(F.col("_k") < F.col("first"))
    words = gone.groupBy("_k", "_t", F.floor(F.col("pos") / 64).cast("int").alias("w")) \
        .agg(F.expr("bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    return words.groupBy("_k", "_t").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("drop"))


# Lines whose bit is not set; words that the map lacks hold no drops.
KEPT = """CASE WHEN `{drop}` IS NULL THEN `{lines}` ELSE
  filter(`{lines}`, (line, i) -> coalesce(
    shiftrightunsigned(try_element_at(`{drop}`, cast(i div 64 as int)), i % 64) & 1 = 0, true)) END"""


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 40, min_docs: int = 5,
                lines: str = "_lines", kept: str = "_kept") -> DataFrame:
    """``docs`` with two array columns, ``lines`` (all lines) and ``kept`` (lines that stay), by a join with the keep bitmaps.

    Every input row comes back once, repeated rows included; a null or empty text is one empty line, which stays.
    Input columns named like the two are replaced; all others pass through, whatever their names.
    """
    docs = docs.drop(*{lines, kept} - {key, text})
    k, t, drop = fresh([*docs.columns, lines, kept], "_k", "_t", "_drop")
    found = dropped_lines(docs, key, text, min_length, min_docs).toDF(k, t, drop)
    rows = docs.select("*", *[c.alias(n) for c, n in zip(_row_id(key, text), (k, t))]).join(found, [k, t], "left")
    rows = rows.withColumn(lines, split_lines(F.col(text)))
    return rows.withColumn(kept, F.expr(KEPT.format(drop=drop, lines=lines))).drop(k, t, drop)


def op10(docs: DataFrame) -> DataFrame:
    d = dedup_lines(docs.select("doc_id", "text"))
    return d.select("doc_id", F.size("_lines").cast("long").alias("n_lines"),
                    (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
                    F.sha2(F.array_join("_kept", "\n"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(list) AS line, generate_subscripts(list, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS list FROM documents)),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE r.key IS NOT NULL AND k.doc_id < r.holder) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos)
              FILTER (WHERE r.key IS NULL OR k.doc_id = r.holder), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r ON k.key = r.key
GROUP BY k.doc_id
"""
