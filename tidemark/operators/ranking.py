"""Ranking, top-k, latest-per-key and gap operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import fresh


def _order(by: str | Column, desc: bool) -> Column:
    c = F.col(by) if isinstance(by, str) else by
    return c.desc_nulls_last() if desc else c.asc_nulls_last()


def top_k(df: DataFrame, by: str, k: int, desc: bool = True, tiebreak: Sequence[str] = (),
          group: Sequence[str] = (), rank_col: str | None = "rank") -> DataFrame:
    """The ``k`` best rows (per ``group`` if given), NULLs last, unique tie-break.

    Per group this is ``row_number() <= k``: Spark inserts a partial
    WindowGroupLimit before the shuffle, so at most k rows per group and map
    task cross the network even when one group is huge. Without groups it is
    ``orderBy().limit()`` (TakeOrderedAndProject).
    """
    order = [_order(by, desc), *[F.col(t).asc_nulls_last() for t in tiebreak]]
    if not group:
        out = df.orderBy(*order).limit(k)
        if rank_col:
            # k rows at most: numbering them in one task is bounded work.
            out = out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
        return out
    w = Window.partitionBy(*group).orderBy(*order)
    rank, = fresh(df.columns, "_rk")
    out = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
    return out.withColumnRenamed(rank, rank_col) if rank_col else out.drop(rank)


def rows_of_top_groups(detail: DataFrame, top: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Detail rows of the selected groups: a left-semi join, never a collected list."""
    return detail.join(top.select(*keys).distinct(), on=list(keys), how="left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest row per key (ties broken by ``tiebreak`` descending).

    ``row_number() == 1`` is planned with a partial WindowGroupLimit, so each
    map task forwards one row per key: a hot key does not flood one reducer.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last(),
                                          *[F.col(t).desc_nulls_last() for t in tiebreak])
    number, = fresh(df.columns, "_rn")
    return df.withColumn(number, F.row_number().over(w)).filter(F.col(number) == 1).drop(number)


def gap_days(df: DataFrame, key: str, date: str, tiebreak: Sequence[str] = (),
             out: str = "days_between_orders", distributed: bool = True, buckets: int | None = None) -> DataFrame:
    """Days since the previous row of the same key ordered by date (+tie-break).

    ``distributed`` (default) numbers ranges of (key, date, tie-break) instead
    of whole keys, so one key with a large share of the rows does not become
    one task (see :func:`tidemark.operators.ntile.bucketed_lag`). The input
    is read twice (count, dealing), so it should be materialized.
    """
    if distributed:
        from tidemark.operators.ntile import SortKey, bucketed_lag
        order = [SortKey(date)] + [SortKey(t) for t in tiebreak]
        before, = fresh(df.columns, "_prev")
        lagged = bucketed_lag(df, key, order, date, before, buckets=buckets)
        return lagged.withColumn(out, F.datediff(F.col(date), F.col(before))).drop(before)
    w = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_first(),
                                        *[F.col(t).asc_nulls_first() for t in tiebreak])
    return df.withColumn(out, F.datediff(F.col(date), F.lag(F.col(date)).over(w)))
