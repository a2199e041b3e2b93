"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed 1- to 3-grams of a bounded, documented sample of labelled documents inside the tasks and
sums them in Spark, so only the (language x feature) table of fixed size reaches the driver. Scoring is one Arrow pass
over the whole texts with the log-probability matrix broadcast (features x languages x 4 bytes).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_crc_mod

UNKNOWN = "und"
CHUNK = 1 << 18  # characters handled at once


def gram_ids(text: str, bits: int, orders: tuple[int, ...] = (1, 2, 3)) -> Iterator[np.ndarray]:
    """Feature ids of the lower-cased text, chunk by chunk; neighbouring chunks overlap so every n-gram occurs once."""
    low = text.lower()
    most = max(orders)
    for at in range(0, len(low), CHUNK):
        c = np.frombuffer(low[at:at + CHUNK + most - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        own = min(CHUNK, len(low) - at)
        for n in orders:
            size = min(own, len(c) - n + 1)
            if size <= 0:
                continue
            h = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                h = (h ^ c[j:j + size]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(13)
            h *= np.uint32(0xC2B2AE35)
            yield h >> np.uint32(32 - bits)


@dataclass
class LanguageModel:
    langs: list[str]
    prior: np.ndarray      # log prior per language
    table: np.ndarray      # features x languages, log probabilities
    bits: int

    def log_scores(self, text: str) -> np.ndarray:
        total = self.prior.copy()
        for ids in gram_ids(text, self.bits):
            total += self.table.take(ids, axis=0).sum(axis=0, dtype=np.float64)
        return total


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = 20_000,
          bits: int = 16, alpha: float = 0.5, max_langs: int = 512) -> LanguageModel:
    """Fit on rows of ``docs`` with non-null text and language.

    Sample bound: about ``max_docs`` documents, taken by a hash of the id (all rows if there are fewer). More than
    ``max_langs`` languages raise, which bounds the broadcast table.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")) \
        .where(F.col("t").isNotNull() & F.col("l").isNotNull())
    n = docs.select(F.col(lang).alias("l")).where(F.col("l").isNotNull()).count()
    if n > max_docs:
        rows = rows.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < int((1 << 20) * max_docs / n))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        docs_in: dict[str, int] = {}
        for pdf in batches:
            for t, l in zip(pdf["t"], pdf["l"]):
                if l not in seen:
                    seen[l] = np.zeros(1 << bits, np.int64)
                    if len(seen) > max_langs:
                        raise ValueError(f"more than {max_langs} languages")
                docs_in[l] = docs_in.get(l, 0) + 1
                for ids in gram_ids(t, bits):
                    seen[l] += np.bincount(ids, minlength=1 << bits)
        for l, c in seen.items():
            f = np.flatnonzero(c)
            yield pd.DataFrame({"l": l, "f": np.r_[-1, f], "n": np.r_[docs_in[l], c[f]]})

    got = rows.mapInPandas(count, "l string, f int, n long").groupBy("l", "f").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["l"].unique())
    if len(langs) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    counts = np.zeros((1 << bits, len(langs)))
    prior = np.zeros(len(langs))
    for j, l in enumerate(langs):
        own = got[got["l"] == l]
        grams = own[own["f"] >= 0]
        counts[grams["f"].to_numpy(), j] = grams["n"].to_numpy()
        prior[j] = own.loc[own["f"] < 0, "n"].sum()
    table = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * (1 << bits))
    prior = np.log(prior / prior.sum()) if langs else prior
    return LanguageModel(langs, prior, table.astype(np.float32), bits)


def predict(docs: DataFrame, model: LanguageModel, text: Column) -> Column:
    """Struct column (lang, score) of the whole text; ``und`` and 0 for a null text or one without any letter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            out = []
            for t in texts:
                if t is None or not m.langs:
                    out.append((UNKNOWN, 0.0))
                    continue
                s = m.log_scores(t)
                p = np.exp(s - s.max())
                best = int(p.argmax())
                out.append((m.langs[best], float(p[best] / p.sum())))
            yield pd.DataFrame(out, columns=["lang", "score"])

    return score(F.when(text.rlike(r"\p{L}"), text))


def language_id(docs: DataFrame, model: LanguageModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: ``key``, ``lang_pred``, ``score``.

    Null or letterless text: ``und`` with score 0. Null ids, repeated rows and ties need nothing special (each row is
    scored alone; equal posteriors go to the first language by name). An empty table gives an empty result; a model
    without languages predicts ``und``. Other input columns are ignored, so their names cannot clash.
    """
    p = docs.select(F.col(key), predict(docs, model, F.col(text)).alias("p"))
    return p.select(key, F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op9(docs: DataFrame) -> DataFrame:
    fold = id_crc_mod("doc_id", 4)
    model = train(docs.where(fold != 2))
    held = F.coalesce(fold == 2, F.lit(False)).alias("held_out")
    p = docs.select("doc_id", held, predict(docs, model, F.col("text")).alias("p"))
    return p.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
