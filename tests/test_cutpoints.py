"""NTILE by cut points equals Spark's own window, also where the selection takes many rounds."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.cutpoints import border_rows, ntiles
from tidemark.operators.ntile import SortKey

SCHEMA = "id long, v double, d decimal(12,2), g string, n int"


def rows(n, seed):
    r = random.Random(seed)
    special = [None, float("nan"), 0.0, float("inf"), -1.5]
    return [(i, r.choice([*special, *[r.random() * 10 for _ in range(9)]]), Decimal(r.randint(-500, 500)) / 100,
             r.choice(["a", "b", "é", None, "\U0001f600", "zz"]), 7 if r.random() < 0.9 else r.randint(0, 9)) for i in range(n)]


def window(tiles):
    out = {}
    for name, (n, order) in tiles.items():
        out[f"{name}_want"] = F.ntile(n).over(Window.orderBy(*[k.order_expr() for k in order]))
    return out


@pytest.mark.parametrize("n,held,sample", [(1, 50, 50), (3, 50, 50), (97, 1_000, 8), (700, 60, 150)])
def test_equals_window(spark, n, held, sample):
    """Several orders at once: NULLs and NaN in both directions, text, a value held by nine tenths, more tiles than rows."""
    df = spark.createDataFrame(rows(n, n), SCHEMA).repartition(3).cache()
    i = SortKey("id")
    tiles = {"a": (5, [SortKey("v"), i]), "b": (2, [SortKey("v", False), i]), "c": (7, [SortKey("g", True, False), SortKey("d", False, True), i]),
             "e": (4, [SortKey("n"), SortKey("id", False)]), "f": (10, [SortKey("d"), i]), "h": (1, [i])}
    if n > held:
        tiles = {name: tiles[name] for name in "bc"}    # each round plans anew
    got = ntiles(df, tiles, held=held, sample=sample).withColumns(window(tiles)).collect()
    assert len(got) == n
    for name in tiles:
        assert [r[name] for r in got] == [r[f"{name}_want"] for r in got], name


def test_rows_equal_in_all_keys_share_a_tile(spark):
    df = spark.createDataFrame([(1,)] * 60 + [(2,)] * 40, "v int")
    got = {tuple(r) for r in ntiles(df, {"t": (4, [SortKey("v")])}, held=5, sample=5).collect()}
    assert got == {(1, 1), (2, 3)} or got == {(1, 1), (2, 4)}


def test_plan_moves_no_row(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    plan = ntiles(df, {"t": (2, [SortKey("v"), SortKey("id")])}, held=600, sample=300)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan and "Join" not in plan


def test_empty_and_unfit_keys(spark):
    empty = spark.createDataFrame([], "v int, t timestamp")
    assert border_rows(empty, {"t": (3, [SortKey("v")])}) == {"t": []}
    assert ntiles(empty, {"t": (3, [SortKey("v")])}).columns == ["v", "t"] and ntiles(empty, {"x": (3, [SortKey("v")])}).count() == 0
    with pytest.raises(TypeError):
        border_rows(empty, {"t": (3, [SortKey("t")])})


def test_later_rounds_read_the_brackets_alone(spark, monkeypatch):
    """The table is read a fixed number of times; rounds after the first go over the written keys of the brackets."""
    from tidemark.operators import cutpoints as C
    seen, fetch = [], C._fetch
    monkeypatch.setattr(C, "_fetch", lambda df, borders, wanted: (seen.append((bool(borders), df.count())), fetch(df, borders, wanted))[1])
    df = spark.createDataFrame([(i, i * 7919 % 5003, None if i % 9 == 0 else f"g{i % 5}", "-") for i in range(5_000)], "id long, v int, g string, more string")
    tiles = {"a": (2, [SortKey("v"), SortKey("id")]), "b": (3, [SortKey("g", False), SortKey("id")])}
    borders = C.border_rows(df, tiles, held=20, sample=200)
    read = [n for any_, n in seen if any_]
    assert read[0] == 5_000 and read == sorted(read, reverse=True) and read.count(5_000) <= 3 and len(read) > 5, seen
    assert all(n <= 5_000 // C.KEPT for n in read if n < 5_000), seen
    monkeypatch.setattr(C, "KEPT", 10**9)
    assert C.border_rows(df, tiles, held=20, sample=200) == borders == C.border_rows(df, tiles)
