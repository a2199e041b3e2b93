"""Approximate nearest neighbours: a forest of random-projection trees with one shared priority queue, exact reranking.

The forest (split directions and thresholds, bounded size) is fitted on a bounded sample and broadcast. Every vector is
routed to one leaf per tree. A query walks all trees through one queue ordered by the margin to the splits it crossed,
and visits the ``probes`` best leaves. Queries and vectors meet leaf by leaf: a large leaf is dealt over several blocks,
each block scores its queries exactly and passes on the best ``k`` only, and a last top-k per query merges them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import groups
from tidemark.operators.materialize import materialize

LEAF = 16                            # vectors of a leaf at least, on average


@dataclass
class Forest:
    """Complete binary trees in heap order: inner node ``n`` has children 2n+1 and 2n+2."""
    depth: int
    normal: np.ndarray    # trees x inner nodes x dims
    level: np.ndarray     # trees x inner nodes
    top: float            # largest norm: vectors are lifted to this norm, so inner product order is nearness

    @property
    def trees(self) -> int:
        return len(self.normal)

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Append the coordinate that gives every vector the norm ``top`` (larger norms get 0)."""
        return np.c_[x, np.sqrt(np.maximum(self.top ** 2 - (x * x).sum(axis=1), 0))]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each vector in each tree: rows x trees."""
        x, out = self.lift(x), np.zeros((len(x), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("nd,nd->n", x, self.normal[t, node]) > self.level[t, node]
                node = 2 * node + 1 + right
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def probe(self, q: np.ndarray, probes: int, sizes: np.ndarray, least: int) -> np.ndarray:
        """The ``probes`` best (tree * leaves + leaf) numbers of a query, by the shared queue, and more until ``least`` ids are met.

        ``sizes``: stored vectors of each leaf; empty leaves are passed over. A tree holds each vector once, so what one
        tree's visited leaves hold are that many distinct ids.
        """
        q = np.r_[q, 0.0]
        margin = self.normal @ q - self.level
        inner, out = (1 << self.depth) - 1, []
        queue = [(-np.inf, t, 0) for t in range(self.trees)]
        met = np.zeros(self.trees, np.int64)
        while queue and (len(out) < probes or met.max() < least):
            cost, t, node = heapq.heappop(queue)
            while node < inner:
                m = margin[t, node]
                near, far = (2 * node + 2, 2 * node + 1) if m > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (max(cost, abs(m)), t, far))
                node = near
            leaf = (t << self.depth) + node - inner
            if sizes[leaf]:
                out.append(leaf)
                met[t] += sizes[leaf]
        return np.array(out)


def fit_forest(sample: np.ndarray, top: float, trees: int, depth: int, seed: int = 11) -> Forest:
    """Each split: direction between two random sample vectors of the node, threshold at the median projection."""
    rng = np.random.default_rng(seed)
    f = Forest(depth, np.zeros((trees, (1 << depth) - 1, sample.shape[1] + 1)), np.zeros((trees, (1 << depth) - 1)), top)
    x = f.lift(sample)
    for t in range(trees):
        members = {0: np.arange(len(x))}
        for node in range((1 << depth) - 1):
            own = members.pop(node)
            if len(own) > 1:
                a, b = rng.choice(len(own), 2, replace=False)
                w = x[own[a]] - x[own[b]]
                norm = np.linalg.norm(w)
                w = w / norm if norm > 0 else rng.normal(size=len(w)) / len(w) ** 0.5
            else:
                w = rng.normal(size=x.shape[1]) / x.shape[1] ** 0.5
            p = x[own] @ w
            f.normal[t, node], f.level[t, node] = w, np.median(p) if len(own) else 0.0
            right = p > f.level[t, node]
            members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]
    return f


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, x): vectors that take part, as bytes of doubles.

    Left out: null ids, null or zero vectors, null or non-finite components, lengths other than the most common one
    (ties: the longer). Of rows that share an id the largest vector counts.
    """
    v = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")).where(
        "id IS NOT NULL AND x IS NOT NULL AND exists(x, e -> e != 0) AND "
        "forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('infinity'))")
    v = v.groupBy("id").agg(F.max("x").alias("x"))
    usual = v.groupBy(F.size("x").alias("n")).agg(F.count("*").alias("c")).agg(F.max_by("n", F.struct("c", "n")).alias("n"))
    return materialize(v.where(F.size("x") == usual.scalar()), "vectors")


def _block_best(k: int):
    """Scores of a leaf block's queries against its vectors; the best ``k`` of each, ties to the smaller id."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for g in groups(batches, ["leaf", "block"]):
            ids, asks = g["id"].to_numpy(), g["ask"].to_numpy()
            if not asks.any() or asks.all():
                continue
            x = np.stack(g["x"].to_numpy())
            x, mine = x[~asks], x[asks]
            who, ids = ids[asks], ids[~asks]
            for at in range(0, len(mine), 256):
                score = np.einsum("qd,nd->qn", mine[at:at + 256], x)
                score[who[at:at + 256, None] == ids[None, :]] = -np.inf
                cut = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(score), -np.inf)
                for q, s, c in zip(who[at:at + 256], score, cut):
                    some = np.flatnonzero((s >= c) & (s > -np.inf))
                    some = some[np.lexsort((ids[some], -s[some]))[:k]]
                    out.append(pd.DataFrame({"query_id": q, "vec_id": ids[some], "score": s[some]}))
                    held += len(some)
            if held > 20_000:
                yield pd.concat(out)
                out, held = [], 0
        if out:
            yield pd.concat(out)
    return run


def nearest(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            trees: int = 16, depth: int = 7, probes: int = 110, sample: int = 8192, block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found per query by inner product in double precision.

    ``rows`` are indexed, all of them; ``queries`` have the same columns; a query's own id is no candidate. The forest
    is fitted on at most about ``sample`` rows, taken by a hash of the id. Ties go to the smaller id. What
    :func:`valid_vectors` leaves out takes no part on either side; empty tables give no rows; columns other than
    ``key`` and ``vector`` are ignored. ``probes`` of ``trees << depth`` leaves are visited: a share of the index, so
    recall holds as the data grows. Empty leaves do not count, and a query goes on until it met ``k`` other ids (all, if
    there are fewer). Small tables have shallower trees.
    """
    spark = rows.sparkSession
    v, q = valid_vectors(rows, key, vector), valid_vectors(queries, key, vector)
    stats = v.agg(F.count("*"), F.max(F.expr("sqrt(aggregate(x, 0D, (s, e) -> s + e * e))"))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not stats[0]:
        return spark.createDataFrame([], schema)
    share = min(1.0, sample / stats[0])
    drawn = v.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < max(1, int((1 << 20) * share))).limit(2 * sample).toPandas()
    if not len(drawn):
        drawn = v.limit(1).toPandas()
    drawn = drawn.sort_values("id")
    points = np.stack(drawn["x"].to_numpy())
    # A small table has fewer leaves: about LEAF vectors in each.
    depth = min(depth, int(max(1, stats[0] // LEAF)).bit_length() - 1)
    forest = spark.sparkContext.broadcast(fit_forest(points, stats[1], trees, depth))

    @F.pandas_udf("array<int>")
    def leaves(x: pd.Series) -> pd.Series:
        f = forest.value
        codes = f.leaves(np.stack(x.to_numpy())) + (np.arange(f.trees) << f.depth) if len(x) else []
        return pd.Series(list(codes), dtype=object)

    placed = materialize(v.withColumn("leaves", leaves("x")), "placed")
    held = np.zeros(trees << depth, np.int64)
    for r in placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n")).collect():
        held[r["leaf"]] = r["n"]

    @F.pandas_udf("array<int>")
    def probed(x: pd.Series) -> pd.Series:
        return pd.Series([forest.value.probe(e, probes, held, k + 1) for e in x], dtype=object)

    asking = materialize(q.withColumn("leaves", probed("x")), "asking")
    # One row per leaf: at most trees << depth. Both sides of a large leaf are dealt over blocks.
    stored = placed.select("id", "x", F.explode("leaves").alias("leaf"))
    asked = asking.select("id", "x", F.explode("leaves").alias("leaf"))
    sizes = stored.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sizes = sizes.join(asked.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("ask_blocks")), "leaf")
    met = None
    for side, ask, own, other in ((stored, False, "blocks", "ask_blocks"), (asked, True, "ask_blocks", "blocks")):
        side = side.join(F.broadcast(sizes), "leaf") \
            .withColumn("mine", F.pmod(F.xxhash64("id"), F.col(own)).cast("int")) \
            .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        at = F.col("mine") * F.col(other) + F.col("theirs") if not ask else F.col("theirs") * F.col(own) + F.col("mine")
        side = side.select("leaf", at.alias("block"), F.lit(ask).alias("ask"), "id", "x")
        met = side if met is None else met.unionByName(side)
    met = met.repartition("leaf", "block").sortWithinPartitions("leaf", "block")
    found = met.mapInPandas(_block_best(k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
