"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: int):
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what runs inside; the setting before comes back after."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def scan_rows(spark: SparkSession, rows: int):
    """Parquet files are decoded at most ``rows`` rows at a time by what runs inside: for tables of large rows."""
    return _setting(spark, "spark.sql.parquet.columnarReaderBatchSize", rows)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column is called so (without regard to case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def id_crc_mod(col: str, m: int) -> Column:
    """``crc32`` of the id as text, modulo ``m`` (NULL for a NULL id)."""
    return F.crc32(F.col(col).cast("string")) % F.lit(m)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, UPPER, UPPER.lower())


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The runs of equal ``keys`` in batches that are sorted by them; a run that spans batches comes out whole."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        g = pdf[keys].to_numpy()
        cut = np.flatnonzero((g[1:] != g[:-1]).any(axis=1)) + 1
        for lo, hi in zip(np.r_[0, cut[:-1]], cut):
            yield pdf.iloc[lo:hi]
        rest = pdf.iloc[cut[-1] if len(cut) else 0:]
    if rest is not None and len(rest):
        yield rest
