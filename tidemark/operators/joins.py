"""Join operators beyond plain equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 from the wall-clock fields (no time-zone
    shift for TIMESTAMP_NTZ)."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def within_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_ts: str, right_ts: str,
                wait_seconds: int, how: str = "left") -> DataFrame:
    """Rows of ``right`` whose time lies in [left_ts, left_ts + wait] for equal keys.

    Time is cut into slots of ``wait_seconds``. A matching right row sits in
    the left row's slot or the next one, so every right row is listed under its
    own slot and the slot before, and the equi-key becomes (keys, slot). Each
    pair is met in exactly one slot (no duplicates; an unmatched left row gives
    one NULL-extended row), and pairs are only formed inside one slot of one
    key, never across a key's whole history: a key holding a large share of
    the rows does not produce a quadratic join.
    """
    l2 = left.withColumn("_slot", F.floor(epoch_seconds(F.col(left_ts)) / wait_seconds))
    r_slot = F.floor(epoch_seconds(F.col(right_ts)) / wait_seconds)
    r2 = right.withColumn("_rslot", F.explode(F.array(r_slot, r_slot - 1)))
    cond = l2["_slot"] == r2["_rslot"]
    for lk, rk in keys:
        cond = cond & (l2[lk] == r2[rk])
    cond = (cond & (r2[right_ts] >= l2[left_ts])
            & (r2[right_ts] <= l2[left_ts] + F.expr(f"INTERVAL {int(wait_seconds)} SECONDS")))
    return l2.join(r2, cond, how).drop("_slot", "_rslot")


def latest_within(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_ts: str, right_ts: str,
                  wait_seconds: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Each row of ``left`` once, with the latest row of ``right`` in [left_ts, left_ts + wait] for equal keys.

    No pairs are formed: both sides are laid on one time line per (keys, slot) and each left row, placed at the
    end of its wait, takes the last right row before it. A right row is listed under its own slot of
    ``wait_seconds`` and the next, so that row is always in the same slot; rows grow linearly however busy a key is.
    Ties in time go to the largest ``tiebreak``. NULL keys or times match nothing; left rows without a match
    keep NULLs on the right.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    end = F.col(left_ts) + F.expr(f"INTERVAL {int(wait_seconds)} SECONDS")
    slot = lambda ts: F.floor(epoch_seconds(ts) / wait_seconds)
    asked = left.select(*[F.col(a).alias(k) for k, (a, _) in zip(names, keys)], slot(end).alias("_slot"), end.alias("_at"),
                        F.lit(1).alias("_ask"), F.struct("*").alias("_l"), F.lit(None).cast(right.schema).alias("_r"))
    own = slot(F.col(right_ts))
    known = right.dropna(subset=[right_ts, *[b for _, b in keys]]).select(
        *[F.col(b).alias(k) for k, (_, b) in zip(names, keys)], F.explode(F.array(own, own + 1)).alias("_slot"),
        F.col(right_ts).alias("_at"), F.lit(0).alias("_ask"), F.lit(None).cast(left.schema).alias("_l"), F.struct("*").alias("_r"))
    line = Window.partitionBy(*names, "_slot").orderBy("_at", "_ask", *[F.col(f"_r.{t}") for t in tiebreak])
    last = F.last("_r", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = known.unionByName(asked).withColumn("_last", last).where("_ask = 1")
    in_time = F.col(f"_last.{right_ts}") >= F.col(f"_l.{left_ts}")
    return met.select("_l.*", *[F.when(in_time, F.col(f"_last.{c}")).alias(c) for c in right.columns])
