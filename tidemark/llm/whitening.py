"""Embedding whitening by Chebyshev-filtered subspace iteration over distributed centred products.

Vectors are first taken to whole numbers on a fixed grid, so sums and means are exact. One pass over the data gives
``XᵀXQ`` of the centred rows for a block ``Q`` of directions: each task adds up one small matrix, Spark adds the tasks'
rows by dimension, and the driver holds matrices of dimensions x block only, never of rows. A filter step applies a
Chebyshev polynomial of the covariance that stays within 1 on the unwanted lower end of the spectrum and grows above
it; QR and Rayleigh-Ritz follow, until the residuals of the wanted pairs certify them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_rows
from tidemark.operators.materialize import materialize

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 52)     # whole numbers up to here are exact as doubles
GUARD = 32                   # directions of the block beyond the wanted ones
DEGREE = 12                  # highest degree of a filter step
GROWTH = 1e8                 # bound of a filter's growth at the largest eigenvalue
CERTIFIED, ROUNDING = 1e-13, 1e-11   # residuals, as shares of the largest eigenvalue: aimed at, and accepted once they stall
RANK = 1e-10                 # eigenvalues below this share of the largest are rounding
CELLS = 1 << 20              # numbers of an Arrow batch


@dataclass
class Spectrum:
    n: int
    sums: list[int]          # exact, per dimension
    values: np.ndarray       # falling eigenvalues of the covariance
    vectors: np.ndarray      # dimensions x components, unit columns
    trace: float
    passes: int              # over the data, for products

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _rows(column: pa.Array) -> np.ndarray:
    """Vectors of an Arrow list column without nulls, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def grid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, x): ``x = floor(1024 c) + 100000`` per entry, as longs.

    Left out: null vectors, null or non-finite entries, entries whose whole number exceeds 2^52, empty vectors, and
    lengths other than the most common one (ties: the longer).
    """
    v = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        f"v IS NOT NULL AND size(v) > 0 AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) * {SCALE} < {LARGEST}D)")
    usual = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c")).agg(F.max_by("d", F.struct("c", "d")).alias("d"))
    return materialize(v.where(F.size("v") == usual.scalar())
                       .select("id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x")), "grid")


def exact_sums(grid: DataFrame) -> tuple[int, list[int]]:
    """Rows, and the exact sum of each dimension (one small table from each task, added up as decimals)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for b in batches:
            x = _rows(b.column(0))
            n += len(x)
            high = high + (x >> 26).sum(axis=0)
            low = low + (x & ((1 << 26) - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high), dtype=np.int32)), pa.array(np.full(len(high), n)),
                                              pa.array(high), pa.array(low)], ["dim", "n", "high", "low"])

    parts = grid.select("x").mapInArrow(run, "dim int, n long, high long, low long")
    got = parts.groupBy("dim").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    got = sorted(got.collect())     # one row per dimension
    return (got[0]["n"] if got else 0), [(int(r["high"]) << 26) + int(r["low"]) for r in got]


def products(rows: DataFrame, column: str, mean: np.ndarray, block: np.ndarray, trace: bool = False) -> np.ndarray:
    """``XᵀX @ block`` of the rows centred on ``mean``; with ``trace`` the sum of all centred squares as a last row."""
    d, width = block.shape
    shared = rows.sparkSession.sparkContext.broadcast((mean, block))
    names = [f"v{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, block = shared.value
        total = np.zeros((d + trace, width))
        for b in batches:
            x = _rows(b.column(0)) - mean
            total[:d] += x.T @ (x @ block)
            if trace:
                total[d, 0] += np.einsum("nd,nd->", x, x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), *map(pa.array, total.T.copy())], ["dim", *names])

    parts = rows.select(column).mapInArrow(run, "dim int, " + ", ".join(f"{c} double" for c in names))
    got = sorted(parts.groupBy("dim").agg(*[F.sum(c).alias(c) for c in names]).collect())  # one row per dimension
    shared.unpersist()
    return np.array([r[1:] for r in got]).reshape(-1, width)


def chebyshev(apply, y: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """The degree's Chebyshev polynomial of the operator on ``[0, cut]``, times ``y``, scaled to 1 at ``top``."""
    half = cut / 2
    sigma = first = half / (top - half)
    before, now = y, (apply(y) - half * y) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - half * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def spectrum(grid: DataFrame, components: int = 8, max_passes: int = 2_000, seed: int = 3) -> Spectrum | None:
    """Leading eigenpairs of the covariance (divisor n) of column ``x``; None without rows.

    Certified by residuals ``|Vq - eq|`` of at most 1e-13 of the largest eigenvalue, or of 1e-11 once rounding keeps
    them from falling; raises if ``max_passes`` products do not get there. Eigenvalues below 1e-10 of the largest are
    left out, so rank-deficient data give fewer components, and constant data none.
    """
    n, sums = exact_sums(grid)
    if not n:
        return None
    found = Spectrum(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0, 0)
    d, mean = len(sums), found.mean
    wide = min(d, components + GUARD)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, wide)))[0]

    def apply(y: np.ndarray) -> np.ndarray:
        found.passes += 1
        return products(grid, "x", mean, y) / n

    w = products(grid, "x", mean, q, trace=True) / n
    found.trace, w, found.passes = float(w[-1, 0]), w[:-1], 1
    if found.trace <= 0:
        return found
    worst = np.inf
    while True:
        small = q.T @ w
        e, turn = np.linalg.eigh((small + small.T) / 2)
        e, turn = e[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        k = min(components, int((e > RANK * e[0]).sum()))
        residual = np.linalg.norm(w[:, :k] - q[:, :k] * e[:k], axis=0).max() / e[0]
        if residual <= CERTIFIED or residual <= ROUNDING and residual > worst / 2:
            found.values, found.vectors = e[:k], q[:, :k] / np.linalg.norm(q[:, :k], axis=0)
            return found
        if found.passes >= max_passes:
            raise RuntimeError(f"{found.passes} passes left a residual of {residual:.1e}")
        worst = residual
        cut = max(float(e[-1]), 1e-3 * e[0])     # never above the block's last eigenvalue, by interlacing, unless that is tiny
        reach = np.arccosh(max(2 * e[0] / cut - 1, 1 + 1e-9))
        degree = int(np.clip(np.log(GROWTH) / reach, 1, DEGREE))
        q = chebyshev(apply, q, cut, float(e[0]), degree)
        q = np.linalg.qr(q / np.maximum(np.linalg.norm(q, axis=0), np.finfo(float).tiny))[0]
        w = apply(q)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of ``(n x - S)^2`` per row, exact; null where it exceeds a long."""
    far = float(np.abs(x - np.array([s / n for s in sums])).max(initial=0)) * n + 2
    if far * far * x.shape[1] < 2 ** 62:
        wrapped = np.array([((s + (1 << 63)) % (1 << 64)) - (1 << 63) for s in sums])   # differences are small: wrapping is exact
        with np.errstate(over="ignore"):
            y = x * np.int64(n) - wrapped
        return pa.array(np.einsum("nd,nd->n", y, y))
    each = (sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return pa.array([v if v < 1 << 63 else None for v in each], pa.int64())


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """Per row of :func:`grid_vectors` and component: ``key``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``.

    ``deviation`` is the exact squared distance from the mean, times n², null beyond a long. Null ids and repeated rows
    are rows like any other (all count in the fit); equal eigenvalues take any basis of their space, the same for all
    rows. Components beyond the rank are left out, so one row, constant data, an empty table or no valid vector give
    no rows. Columns other than the two named are ignored.
    """
    spark = rows.sparkSession
    grid = grid_vectors(rows, key, vector)
    id_type = grid.schema["id"].dataType.simpleString()
    schema = f"`{key}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width = grid.select(F.size("x").alias("d")).first()
    if width is None:
        return spark.createDataFrame([], schema)
    with arrow_rows(spark, max(1, min(10_000, CELLS // width["d"]))):
        s = spectrum(grid, components)
        if not len(s.values):
            return spark.createDataFrame([], schema)
        shared = spark.sparkContext.broadcast((s.n, s.sums, s.mean, s.vectors / np.sqrt(s.values)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums, mean, turn = shared.value
            for b in batches:
                x = _rows(b.column("x"))
                z = (x - mean) @ turn
                at = pa.array(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([b.column("id"), _deviations(x, n, sums), pa.ListArray.from_arrays(at, z.ravel())],
                                                 ["id", "deviation", "z"])

        scored = materialize(grid.mapInArrow(run, f"id {id_type}, deviation long, z array<double>"), "whitened")
        k = len(s.values)
        middle = np.array(scored.agg(*[F.avg(F.get("z", F.lit(i))) for i in range(k)]).first())
        error = float(np.abs(products(scored, "z", middle, np.eye(k)) / s.n - np.eye(k)).max())
    share = F.array(*[F.lit(float(e / s.trace)) for e in s.values])
    return scored.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        F.col("id").alias(key), (F.col("at") + 1).alias("component"), F.lit(s.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op11(vectors: DataFrame) -> DataFrame:
    return whiten(vectors)
