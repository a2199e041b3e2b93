"""Connected components by star contraction, over edges that stay in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.materialize import materialize


def _least(edges: DataFrame, name: str) -> DataFrame:
    """Smallest ``v`` of each ``u``. Written, so that a join with it meets two plain exchanges, of which Spark splits a hub."""
    return materialize(edges.groupBy("u").agg(F.min("v").alias("m")), f"{name}_least")


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(id, comp): smallest id of the component of every node of ``edges`` (a, b) that is not itself the smallest.

    Alternating large-star and small-star contraction; each pass is written, so a lost executor costs one pass.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), name)
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select(F.col("u").alias("id"), F.col("v").alias("comp"))
        before = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both, name).select("u", F.least("u", "m").alias("m"))
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                            f"{name}_large")
        small = large.join(_least(large, name), "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = materialize(small.select("x.u", "x.v").where("u != v").distinct(), name)
