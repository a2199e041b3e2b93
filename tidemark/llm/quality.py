"""Quality classifier: supervised subword embeddings (hashed word and character n-gram vectors, softmax output).

A document is the mean of the learned vectors of its hashed words and byte 3- and 4-grams. Training is numpy
stochastic gradient descent on a bounded, documented number of labelled documents per class. The output is linear in
the mean, so for scoring each vector is projected once onto the difference of the two output rows: the broadcast model
is one number per feature bucket, and scoring gathers and averages numbers over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_crc_mod
from tidemark.llm.textnum import windows, word_hashes


def feature_ids(text: str, bits: int) -> Iterator[np.ndarray]:
    """Bucket ids of the words and byte 3-/4-grams, window by window (n-grams do not cross 1 MiB windows)."""
    for piece, _ in windows(text.encode("utf-8", "surrogatepass")):
        yield (word_hashes(piece) >> np.uint64(64 - bits)).astype(np.uint32)
        b = np.frombuffer(piece, np.uint8).astype(np.uint32)
        if len(b) < 3:
            continue
        three = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)
        yield (three ^ three >> np.uint32(15)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits)
        four = (b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)) * np.uint32(0xC2B2AE35)
        yield (four ^ four >> np.uint32(13)) * np.uint32(0x27D4EB2F) >> np.uint32(32 - bits)


@dataclass
class QualityModel:
    weight: np.ndarray     # one number per feature bucket: vector . (output row 1 - output row 0)
    bias: float
    bits: int

    def score(self, text: str | None) -> float:
        total, n = 0.0, 0
        for ids in feature_ids(text or "", self.bits):
            total += float(self.weight[ids].sum(dtype=np.float64))
            n += len(ids)
        z = (total / n if n else 0.0) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit(sample: pd.DataFrame, bits: int, prior: float, dim: int = 8, epochs: int = 6, rate: float = 0.5,
        seed: int = 7) -> QualityModel:
    """SGD over documents given as (label, bucket ids, weights summing to 1)."""
    rng = np.random.default_rng(seed)
    vec = rng.normal(0, 0.1, (1 << bits, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (2, dim)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    rows = [(int(y), np.frombuffer(i, np.uint32), np.frombuffer(w, np.float32))
            for y, i, w in zip(sample["y"], sample["ids"], sample["w"])]
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            y, ids, w = rows[r]
            lr = rate * (1 - done / steps)
            done += 1
            own = vec[ids]
            mean = w @ own
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ out
            out -= lr * np.outer(p, mean)
            bias -= lr * p
            # The mean spreads the gradient over many buckets; scale it back to a per-bucket step.
            vec[ids] = own - np.float32(lr * min(len(ids), 200)) * w[:, None] * back
    n1 = sum(y for y, _, _ in rows)
    shift = 0.0
    if 0 < n1 < len(rows) and 0 < prior < 1:  # the sample is balanced by class; the score should follow the full table
        shift = np.log(prior / (1 - prior)) - np.log(n1 / (len(rows) - n1))
    return QualityModel((vec @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0] + shift), bits)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          max_per_class: int = 2_000, bits: int = 17) -> QualityModel:
    """Fit on labelled rows.

    Sample bound: ``max_per_class`` documents of each label, the first by a hash of the id; their features (not their
    texts) reach the driver. Null labels or ids and ids with contradicting labels are left out. Without labelled rows
    the model scores 0.5 everywhere.
    """
    own = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")) \
        .where(F.col("k").isNotNull() & F.col("y").isin(0, 1)) \
        .groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2").select("k", "y")
    share = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = None
    for y in (0, 1):
        part = own.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(max_per_class)
        pick = part if pick is None else pick.union(part)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for y, t in zip(pdf["y"], pdf["t"]):
                ids, n = np.unique(np.concatenate([np.empty(0, np.uint32), *feature_ids(t or "", bits)]), return_counts=True)
                if len(ids):
                    rows.append((y, ids.astype(np.uint32).tobytes(), (n / n.sum()).astype(np.float32).tobytes()))
            yield pd.DataFrame(rows, columns=["y", "ids", "w"])

    # At most 2 * max_per_class ids: a broadcast of proven size.
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(pick), "k") \
        .select("y", "t", "k")
    sample = rows.mapInPandas(featurise, "y int, ids binary, w binary").toPandas()
    if not len(sample):
        return QualityModel(np.zeros(1 << bits, np.float32), 0.0, bits)
    sample = sample.sort_values(["y", "ids"], kind="stable", ignore_index=True)  # independent of task order
    prior = share.get(1, 0) / max(1, sum(share.values()))
    return fit(sample, bits, prior)


def quality_score(docs: DataFrame, model: QualityModel, text: Column) -> Column:
    """Score column of the whole text (a null text counts as empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            yield pd.Series([m.score(t) for t in texts], dtype="float64")

    return score(text)


def quality(docs: DataFrame, model: QualityModel, text: str = "text", key: str = "doc_id",
            threshold: float = 0.3) -> DataFrame:
    """One row per input row: ``key``, ``score`` in 0..1, ``predicted`` (1 if the score reaches the threshold).

    Empty and null texts get the score of a text without features (the bias). Null ids and repeated rows are scored
    like any other; an empty table gives an empty result; other columns are ignored.
    """
    s = docs.select(F.col(key), quality_score(docs, model, F.col(text)).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels.where(id_crc_mod("doc_id", 5) != 0))
    held = F.coalesce(id_crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    s = docs.select("doc_id", held, quality_score(docs, model, F.col("text")).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
