"""Keys for sources and sinks: each writes data derived from the given tables
to the shared folder, reads it back through the operator, and is compared with
the source table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from tidemark.operators.upsert import publish, read_table
from tidemark.plans.registry import register
from tidemark.plans.retail import ORACLES as RETAIL_SQL, sales_type
from tidemark.plans.views import table, v_depts, v_spend, v_stores
from tidemark.session import scratch_path
from tidemark.sources.readers import read_csv, read_dated, read_evolving, write_partitioned, write_snappy

ORDERS_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
    StructField("o_orderdate", TimestampNTZType()), StructField("o_orderpriority", StringType())])


def q_csv_typed(spark, sf):
    path = scratch_path(spark, "orders_csv")
    (table(spark, sf, "orders").write.option("header", True).option("lineSep", "\r\n")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return read_csv(spark, path, ORDERS_SCHEMA)


register("csv_typed_read", "SELECT * FROM orders")(q_csv_typed)

STORES_SCHEMA = StructType([StructField("store_id", IntegerType()), StructField("type", StringType()),
                            StructField("size", IntegerType()), StructField("store_name", StringType())])


def q_csv_null_tokens(spark, sf):
    s = v_stores(spark, sf)
    k = F.col("store_id")
    txt = s.select(
        k.cast("string").alias("store_id"),
        F.when(k % 7 == 0, F.lit("NA")).when(k % 11 == 0, F.lit("na")).otherwise(F.col("type")).alias("type"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.col("size").cast("string")).alias("size"),
        F.concat(F.lit("Store, #"), k.cast("string")).alias("store_name"))
    path = scratch_path(spark, "stores_csv")
    txt.write.option("header", True).option("lineSep", "\r\n").option("emptyValue", "").csv(path)
    return read_csv(spark, path, STORES_SCHEMA, null_tokens_=("NA", "na"))


register("csv_null_tokens", """SELECT CAST(s_suppkey AS INTEGER) AS store_id,
  CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 THEN NULL
       ELSE CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END END AS type,
  CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE CAST(30000 + (s_suppkey * 7919) % 190000 AS INTEGER) END AS size,
  'Store, #' || CAST(s_suppkey AS VARCHAR) AS store_name FROM supplier""")(q_csv_null_tokens)


def q_parquet_glob(spark, sf):
    path = scratch_path(spark, "lineitem_parts")
    table(spark, sf, "lineitem").write.parquet(path)
    spark.read.parquet(f"{path}/*.parquet").createOrReplaceTempView("lineitem_parts")
    return spark.table("lineitem_parts")


register("parquet_glob_read", "SELECT * FROM lineitem")(q_parquet_glob)


def q_snappy(spark, sf):
    path = scratch_path(spark, "orders_snappy")
    write_snappy(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


register("parquet_snappy_write", "SELECT * FROM orders")(q_snappy)


def q_partitioned_append(spark, sf):
    """Orders landed by year, month and day (some 2,400 daily directories): a second load appends later days, and rows to
    days of a month that is there already."""
    o = table(spark, sf, "orders")
    o = o.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate"), "day": F.dayofmonth("o_orderdate")})
    path = scratch_path(spark, "orders_by_day")
    month = F.col("year") * 100 + F.col("month")
    second = F.coalesce((month > 199507) | ((month == 199507) & (F.col("o_orderkey") % 2 == 1)), F.lit(False))
    for load in (~second, second):
        write_partitioned(o.filter(load), path, ["year", "month", "day"])
    return spark.read.parquet(path)


register("partitioned_append", """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day FROM orders""")(q_partitioned_append)


def q_schema_evolve(spark, sf):
    """Three generations of files: int, bigint and text nation, with and without balance and segment; no schema given."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    parts = [c.filter(key % 3 == 0).select(key.cast("int").alias("c_custkey"), "c_name", "c_acctbal", F.col("c_nationkey").cast("int")),
             c.filter(key % 3 == 1).select(key.cast("bigint").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("bigint").alias("C_NationKey"),
                                           F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal")),
             c.filter(key % 3 == 2).select(key.cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment",
                                           F.concat(F.lit("N"), F.col("c_nationkey")).alias("c_nationkey"))]
    paths = [scratch_path(spark, f"customers_{i}") for i in range(len(parts))]
    for part, path in zip(parts, paths):
        part.write.parquet(path)
    return read_evolving(spark, paths)


register("schema_evolve_union", """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name,
  CASE c_custkey % 3 WHEN 0 THEN c_acctbal WHEN 1 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) END AS c_acctbal,
  CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 3 = 2 THEN 'N' ELSE '' END || CAST(c_nationkey AS VARCHAR) AS c_nationkey
  FROM customer""")(q_schema_evolve)


def q_table_overwrite(spark, sf):
    d = scratch_path(spark, "tbl_sales_type")
    rpt = sales_type(v_depts(spark, sf), v_stores(spark, sf))
    publish(rpt.limit(0), d)      # first version: empty table with the schema
    publish(rpt, d)               # overwrite: new version, pointer swapped
    return read_table(spark, d)


register("table_overwrite", RETAIL_SQL["rpt_sales_type"])(q_table_overwrite)

SPEND_SCHEMA = StructType([StructField("date", StringType()), StructField("channel", StringType()),
                           StructField("spend", DoubleType())])
RUN_DATE = dt.date(2024, 1, 16)


def q_dated(spark, sf, run_date: dt.date = RUN_DATE):
    root = scratch_path(spark, "spend_files")
    sp = v_spend(spark, sf).withColumn("file_date", F.col("date"))
    sp.write.partitionBy("file_date").json(root)
    return read_dated(spark, root + "/file_date={date}", run_date, SPEND_SCHEMA)


register("dated_file_read", """SELECT channel, spend, CAST(d AS DATE) AS spend_date FROM (
  SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE) - INTERVAL 2 DAY, CAST(max(ts) AS DATE) + INTERVAL 2 DAY,
        INTERVAL 1 DAY)) AS DATE) AS d FROM events) days
  CROSS JOIN (VALUES ('facebook_paid_ads', 0), ('youtube_paid_ads', 1), ('tiktok_paid_ads', 2), ('organic_search', 3))
    c(channel, ch_idx),
  LATERAL (SELECT CAST((dayofyear(d) * 31 + ch_idx * 7) % 500 AS DOUBLE)
                  + CAST((dayofyear(d) * 31 + ch_idx * 7) % 4 AS DOUBLE) * 0.25 AS spend)
  WHERE d = DATE '2024-01-15'""")(q_dated)
