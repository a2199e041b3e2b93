"""Exact NTILE and lag over a whole table (or per group) without a single-task window.

``Window.orderBy(x)`` with no partition moves every row into one task, and a
window partitioned by a hot key moves that key into one. Here Spark's own range
partitioning deals the rows by the whole composite key (groups, sort keys,
tie-breaks); inside a range a row's place is its position in the sorted
partition, and a small table of range sizes turns places into global positions.
The plan is the same at every size: the number of ranges follows the row count.

The dealt rows are written once, because range bounds come from a sample: every
later step reads the same assignment, also after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import fresh
from tidemark.operators.materialize import materialize

ROWS_PER_RANGE = 1_000_000
MANY_RANGES = 256           # beyond, smaller ranges than ROWS_PER_RANGE grow with the table: the driver samples 100 rows and more a range
_PLACE_BITS = 33            # monotonically_increasing_id: partition number above, row position below


@dataclass(frozen=True)
class SortKey:
    col: str
    ascending: bool = True
    nulls_first: bool | None = None  # None = Spark default (asc: first, desc: last)

    def order_expr(self) -> Column:
        c = F.col(self.col)
        nulls_first = self.ascending if self.nulls_first is None else self.nulls_first
        if self.ascending:
            return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()


def _as_keys(order) -> list[SortKey]:
    return [o if isinstance(o, SortKey) else SortKey(o) if isinstance(o, str) else SortKey(*o) for o in order]


def tile_of(idx: Column, total: Column, n: int) -> Column:
    """NTILE number of the 1-based position ``idx`` among ``total`` rows."""
    q = F.floor(total / F.lit(n))
    r = total - q * F.lit(n)
    big = r * (q + 1)
    return (F.when(q == 0, idx)
            .when(idx <= big, F.floor((idx - 1) / (q + 1)) + 1)
            .otherwise(r + F.floor((idx - big - 1) / q) + 1)).cast("int")


def range_rows(rows: int, rows_per_bucket: int) -> int:
    """Rows of a range in a table of ``rows``: small ranges only up to ``MANY_RANGES`` of them."""
    return max(rows_per_bucket, min(ROWS_PER_RANGE, rows // MANY_RANGES))


def dealt_in_ranges(df: DataFrame, keys: Sequence[SortKey], buckets: int | None = None,
                    rows_per_bucket: int = ROWS_PER_RANGE, total: int | None = None,
                    bucket: str = "_bucket", place: str = "_place") -> DataFrame:
    """``df`` range-partitioned and sorted on ``keys``, with ``bucket`` (range number) and ``place``
    (position in it, from 0), written to the shared folder. No column may have these two names yet.

    Ranges ascend with the key, so equal leading keys lie in neighbouring ranges. Only rows equal in all of
    ``keys`` cannot be parted: give tie-breaks up to a unique key.
    """
    if buckets is None:
        rows = df.count() if total is None else total
        buckets = max(2, -(-rows // range_rows(rows, rows_per_bucket)))
    order = [k.order_expr() for k in keys]
    placed = (df.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
              .withColumn(place, F.monotonically_increasing_id()))
    return materialize(placed.withColumns({
        bucket: F.shiftright(place, _PLACE_BITS).cast("int"),
        place: F.col(place).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}), "ranges")


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def global_ntile(df: DataFrame, n: int, order, out: str = "ntile", partition_by: Sequence[str] = (),
                 buckets: int | None = None, rows_per_bucket: int = ROWS_PER_RANGE,
                 total: int | None = None) -> DataFrame:
    """Add ``out`` = NTILE(n) OVER (PARTITION BY partition_by ORDER BY order).

    ``order`` is a list of column names, ``(name, ascending)`` pairs or
    :class:`SortKey`. Give a full tie-break so the result is reproducible and
    equal keys can be parted. ``total`` saves the counting pass over ``df``.
    """
    groups = list(partition_by)
    bucket, place = fresh(df.columns, "_bucket", "_place")
    dealt = dealt_in_ranges(df, [*_as_keys(groups), *_as_keys(order)], buckets, rows_per_bucket, total, bucket, place)
    # One row per (group, range). A group's rows are neighbours, so its first place in a range is known.
    sizes = dealt.groupBy(F.col(bucket).alias("_b"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]) \
        .agg(F.count(F.lit(1)).alias("_cnt"), F.min(place).alias("_from"))
    of = [f"_g{i}" for i in range(len(groups))]
    before = Window.partitionBy(*of).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_b", *of, (F.coalesce(F.sum("_cnt").over(before), F.lit(0)) - F.col("_from")).alias("_shift"),
                         F.sum("_cnt").over(Window.partitionBy(*of)).alias("_total"))
    res = dealt.join(sizes, (dealt[bucket] == sizes["_b"]) & _same(dealt, sizes, list(zip(groups, of))), "inner")
    tile = tile_of(dealt[place] + sizes["_shift"] + 1, sizes["_total"], n)
    return res.select(*[dealt[c] for c in df.columns if c != out], tile.alias(out))


def bucketed_lag(df: DataFrame, key: str, order, value: str, out: str, buckets: int | None = None,
                 rows_per_bucket: int = ROWS_PER_RANGE, total: int | None = None) -> DataFrame:
    """``lag(value) OVER (PARTITION BY key ORDER BY order)`` without one task per key.

    A key holding a large share of the rows spans several ranges of (key,
    order...). Inside a range the lag is a normal window; the first row of a key
    in a range takes the last ``value`` of that key in the range before, from a
    table with one row per (key, range). ``value`` must be the first ``order``
    column (ascending), so the last value of a range is its maximum.
    """
    okeys = _as_keys(order)
    if okeys[0].col != value or not okeys[0].ascending:
        raise ValueError("value must be the leading ascending order column")
    bucket, place, lag, first = fresh([*df.columns, out], "_bucket", "_place", "_lag", "_first")
    dealt = dealt_in_ranges(df, [SortKey(key), *okeys], buckets, rows_per_bucket, total, bucket, place)
    w = Window.partitionBy(bucket, key).orderBy(place)
    local = dealt.withColumns({lag: F.lag(value).over(w), first: F.row_number().over(w) == 1})
    tails = dealt.groupBy(F.col(bucket).alias("_b"), F.col(key).alias("_k")).agg(F.max(value).alias("_max"))
    tails = tails.select("_b", "_k", F.lag("_max").over(Window.partitionBy("_k").orderBy("_b")).alias("_tail"))
    # The windowed rows are already hash-partitioned on (range, key): only the tail table moves for this join.
    j = local.join(tails, (local[bucket] == tails["_b"]) & local[key].eqNullSafe(tails["_k"]), "left")
    val = F.when(local[first], tails["_tail"]).otherwise(local[lag])
    return j.select(*[local[c] for c in df.columns if c != out], val.alias(out))
