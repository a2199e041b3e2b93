"""Cut lineage by writing to the shared folder (survives executor loss)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_path


def materialize(df: DataFrame, name: str = "stage", **options: int | str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Used where a derived table is read several times (ntile passes, report
    families): the upstream plan runs once and later stages restart from the
    files rather than from the full lineage. ``options``: of the Parquet writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").options(**options).parquet(path)
    return spark.read.parquet(path)
