"""Corpus pipeline over ``documents``: quality, line deduplication, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet under the shared checkpoint
folder and hands what it reads back to the next stage. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, minhash, mixing, packing, quality
from tidemark.llm.common import fresh, table
from tidemark.operators.materialize import materialize

THRESHOLD = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as label 1; it learns from every labelled document among ``docs``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(docs, model, F.col("text")) >= THRESHOLD)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat across documents; ``n_chars`` follows the text."""
    lines, kept = fresh(docs.columns, "_lines", "_kept")
    out = line_dedup.dedup_lines(docs, lines=lines, kept=kept).withColumn("text", F.array_join(kept, "\n"))
    return out.withColumn("n_chars", F.length("text").cast("long")).drop(lines, kept)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component."""
    found = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_kept_id"]), "left_semi")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the languages' expected tokens match the targets; every document stays."""
    return mixing.mixed_documents(docs, mixing.labelled_by_language(docs), mixing.TARGETS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1024 tokens."""
    return packing.pack(docs, packing.ranks_path())


STAGES = [("quality classifier", quality_stage), ("line dedup", line_stage), ("MinHash near-dedup", near_duplicate_stage),
          ("mixing to target weights", mixing_stage), ("packing", packing_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
