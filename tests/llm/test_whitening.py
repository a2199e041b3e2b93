"""Whitening against numpy's eigenvectors, and its edge cases."""

import math

import numpy as np
import pytest

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, id string, x int, z string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "s", 1, "z", 7) for i, v in rows], SCHEMA)


def on_grid(vectors):
    return np.floor(1024 * np.array(vectors, float)) + 100_000


def check(got, ids, x, components=8):
    """Every column of the result against eigenvectors of numpy's covariance."""
    n, mean = len(x), x.mean(axis=0)
    e, q = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-10 * e[0]).sum()))
    assert len(got) == n * k and set(got["component"]) == set(range(1, k + 1))
    assert (got["n"] == n).all() and got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    exact = {i: int(sum((n * int(v) - s) ** 2 for v, s in zip(row, map(int, x.sum(axis=0))))) for i, row in zip(ids, x)}
    assert {r.vec_id: r.deviation for r in got.itertuples()} == exact
    for j in range(k):
        part = got[got["component"] == j + 1].set_index("vec_id").loc[ids]
        want = (x - mean) @ q[:, j] / math.sqrt(e[j])
        sign = np.sign(want @ part["whitened"].to_numpy())
        assert np.allclose(sign * part["whitened"], want, atol=1e-7)
        assert np.allclose(part["explained"], e[j] / e.sum(), rtol=1e-9)


def test_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    seen = rows.toPandas()
    check(whitening.op11(rows).toPandas(), seen["vec_id"].tolist(), on_grid(seen["embedding"].tolist()))


def test_many_dimensions_use_the_filter(spark):
    """More dimensions than the block, a flat spectrum with close eigenvalues, and tiny partitions."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(400, 90)) * np.r_[np.linspace(3, 1, 10), np.ones(80)]
    ids = list(range(400))
    rows = frame(spark, [(i, r.tolist()) for i, r in zip(ids, v)]).repartition(7)
    check(whitening.op11(rows).toPandas(), ids, on_grid(v))
    grid = whitening.grid_vectors(rows, "vec_id", "embedding")
    found = whitening.spectrum(grid)
    assert found.passes > 12 and np.allclose(found.vectors.T @ found.vectors, np.eye(8), atol=1e-12)
    with pytest.raises(RuntimeError):
        whitening.spectrum(grid, max_passes=2)


def test_what_is_left_out(spark):
    good = [(i, [math.sin(3 * i), math.cos(i * i), i / 7]) for i in range(1, 30)]
    bad = [(40, None), (41, [1.0, None, 2.0]), (42, [float("nan"), 0.0, 0.0]), (43, [float("inf"), 0.0, 0.0]),
           (44, [1.0, 2.0]), (45, []), (46, [1e300, 0.0, 0.0])]
    got = whitening.op11(frame(spark, good + bad)).toPandas()
    check(got, [i for i, _ in good], on_grid([v for _, v in good]))


def test_null_and_large_ids_and_repeated_rows(spark):
    big = (1 << 60) + 1
    rows = [(None, [1.0, 0.0]), (big, [0.0, 2.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5]), (-1, [-1.0, 1.0])]
    got = whitening.op11(frame(spark, rows)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == sorted([(True, 0), (False, big), (False, 5), (False, 5), (False, -1)] * 2)
    assert {r["n"] for r in got} == {5}


def test_rank(spark):
    """Constant data, one row and no rows have no components; a line has one."""
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)]):
        got = whitening.op11(frame(spark, rows))
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = whitening.op11(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(50)])).toPandas()
    assert set(line["component"]) == {1} and len(line) == 50 and abs(line["explained"] - 1).max() < 1e-9


def test_deviations_stay_exact():
    n, sums, x = 3, [1 << 60, -(1 << 61)], np.array([[1 << 51, -(1 << 50)], [5, 7]])
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    assert whitening._deviations(x, n, sums).to_pylist() == [v if v < 1 << 63 else None for v in want]
    x, sums = np.array([[100_001, 99_990], [100_000, 100_020]]), [10 ** 15 + 3, 10 ** 15 - 9]
    want = [sum((10 ** 10 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    assert whitening._deviations(x, 10 ** 10, sums).to_pylist() == [v if v < 1 << 63 else None for v in want]
