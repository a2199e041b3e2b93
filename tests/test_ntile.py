"""Distributed NTILE == single-window NTILE (brute force) on edge frames."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ntile import SortKey, dealt_in_ranges, global_ntile


def brute(df, n, order_cols, partition=()):
    w = Window.partitionBy(*partition).orderBy(*order_cols) if partition else Window.orderBy(*order_cols)
    return df.withColumn("expect", F.ntile(n).over(w))


def rows(n, seed, heavy=False, nulls=False):
    r = random.Random(seed)
    out = []
    for i in range(n):
        v = 7 if heavy and r.random() < 0.9 else r.randint(0, 50)
        if nulls and r.random() < 0.1:
            v = None
        out.append((i, v, r.choice("abc")))
    return out


@pytest.mark.parametrize("n_rows,k,buckets,heavy,nulls", [
    (3, 5, 4, False, False),        # N < k
    (97, 5, 6, False, False),       # N not divisible by k
    (400, 2, 8, True, False),       # one key holds 90% of rows
    (300, 10, 5, False, True),      # NULL sort keys
    (1, 3, 1, False, False),
])
def test_global_ntile_matches_window(spark, n_rows, k, buckets, heavy, nulls):
    df = spark.createDataFrame(rows(n_rows, n_rows + k, heavy, nulls), "id long, v int, g string")
    got = global_ntile(df, k, [SortKey("v"), SortKey("id")], out="t", buckets=buckets)
    exp = brute(df, k, [F.col("v").asc_nulls_first(), F.col("id")])
    j = got.join(exp, "id")
    assert j.count() == n_rows
    assert j.filter(F.col("t") != F.col("expect")).count() == 0


def test_descending_and_partitioned(spark):
    df = spark.createDataFrame(rows(500, 3, heavy=True), "id long, v int, g string")
    got = global_ntile(df, 4, [SortKey("v", False), SortKey("id")], out="t", partition_by=["g"], buckets=7)
    exp = brute(df, 4, [F.col("v").desc_nulls_last(), F.col("id")], partition=["g"])
    assert got.join(exp, "id").filter(F.col("t") != F.col("expect")).count() == 0


def test_no_single_partition_numbering(spark):
    df = spark.createDataFrame(rows(200, 1), "id long, v int, g string")
    hot = df.withColumn("v", F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("v")))
    sizes = [r["count"] for r in dealt_in_ranges(hot, [SortKey("v"), SortKey("id")], rows_per_bucket=20)
             .groupBy("_bucket").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 60        # 90 % of the rows share one value
    # The rows are dealt by Spark's range partitioning; the only single partition is the table of range sizes.
    got = global_ntile(hot, 5, ["v", "id"], out="t", rows_per_bucket=20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1 and "Window" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "CartesianProduct" not in plan


def test_null_groups_and_null_keys(spark):
    df = spark.createDataFrame([(i, i % 4 or None, None if i % 3 == 0 else "ab"[i % 2]) for i in range(120)], "id long, v int, g string")
    got = global_ntile(df, 4, ["v", "id"], out="t", partition_by=["g"], rows_per_bucket=10)
    exp = brute(df, 4, [F.col("v").asc_nulls_first(), F.col("id")], partition=["g"])
    j = got.join(exp, "id")
    assert j.count() == 120 and j.filter(F.col("t") != F.col("expect")).count() == 0


@pytest.mark.parametrize("buckets", [1, 3, 9])
def test_bucketed_lag_matches_window(spark, buckets):
    from tidemark.operators.ranking import gap_days
    r = random.Random(buckets)
    data = [(i, "hot" if r.random() < 0.6 else f"u{r.randint(0, 20)}", r.randint(0, 60)) for i in range(600)]
    df = spark.createDataFrame(data, "id long, user string, d int").withColumn(
        "day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    got = gap_days(df, "user", "day", ["id"], out="g", buckets=buckets)
    exp = gap_days(df, "user", "day", ["id"], out="e", distributed=False)
    j = got.join(exp.select("id", "e"), "id")
    assert j.count() == 600
    assert j.filter(~F.col("g").eqNullSafe(F.col("e"))).count() == 0


def test_keys_of_awkward_types(spark):
    import datetime as dt
    from decimal import Decimal
    r = random.Random(5)
    names = ["o'brien", "back\\slash", "plain", "", "ünï", 'dq"x']
    data = [(i, r.choice(names), Decimal(r.randint(-500, 500)) / 100, dt.date(2024, 1, 1) + dt.timedelta(r.randint(0, 40)),
             r.choice([1.5, -0.25, float("nan"), 1e-9])) for i in range(400)]
    df = spark.createDataFrame(data, "id long, s string, d decimal(6,2), day date, x double")
    order = [SortKey("s"), SortKey("d"), SortKey("day"), SortKey("x"), SortKey("id")]
    got = global_ntile(df, 7, order, out="t", buckets=11)
    exp = brute(df, 7, [F.col(c) for c in ("s", "d", "day", "x", "id")])
    assert got.join(exp, "id").filter(F.col("t") != F.col("expect")).count() == 0


def test_columns_named_like_the_operators_own(spark):
    """Columns called like the operators' working columns come through unchanged."""
    from tidemark.operators.cutpoints import ntiles
    from tidemark.operators.ntile import bucketed_lag
    from tidemark.operators.ranking import gap_days, latest_per_key, top_k
    from tidemark.plans.restaurant import attach_scalar
    names = ["_bucket", "_place", "_b", "_k", "_g0", "_shift", "_total", "_cnt", "_from", "_lag", "_first", "_max", "_tail", "_rn", "_rk", "_prev", "_s"]
    df = spark.createDataFrame([(i, i % 3, f"2024-01-{i % 28 + 1:02d}") for i in range(60)], "id int, g int, d string") \
        .select("id", "g", F.to_date("d").alias("d"), *[F.lit(n).alias(n) for n in names])
    tiles = brute(df, 4, [F.col("id")], ["g"])
    results = [global_ntile(df, 4, ["id"], out="t", partition_by=["g"], rows_per_bucket=9), bucketed_lag(df, "g", ["d", "id"], "d", "before", rows_per_bucket=9),
               ntiles(df, {"x": (3, [SortKey("id")])}), top_k(df, "id", 4, group=["g"]), latest_per_key(df, ["g"], "d", ["id"]),
               gap_days(df, "g", "d", ["id"]), attach_scalar(df, df.agg(F.max("id").alias("top")))]
    for r in results:
        assert r.columns[:len(df.columns)] == df.columns
        assert {tuple(x) for x in r.select(*names).distinct().collect()} == {tuple(names)}
    assert results[0].join(tiles.select("id", "expect"), "id").filter(F.col("t") != F.col("expect")).count() == 0


def test_ranges_do_not_multiply_with_the_rows(spark, monkeypatch):
    """Small ranges are an exercise for small tables: their number is bounded, as the driver samples each of them."""
    from tidemark.operators import ntile as N
    assert -(-144_000_000 // N.range_rows(144_000_000, 5_000)) <= 256 and N.range_rows(40_000, 5_000) == 5_000
    assert N.range_rows(10**10, 5_000) == N.ROWS_PER_RANGE == N.range_rows(10**10, N.ROWS_PER_RANGE)
    monkeypatch.setattr(N, "MANY_RANGES", 4)
    df = spark.createDataFrame(rows(200, 1), "id long, v int, g string")
    assert dealt_in_ranges(df, [SortKey("v"), SortKey("id")], rows_per_bucket=2).select("_bucket").distinct().count() <= 4
