"""End-to-end batch jobs of the reference, composed from the operators.

Each job reads its inputs with explicit schemas, runs the same plans as the
registered keys, and writes results as snappy Parquet / versioned tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, DoubleType, IntegerType, StringType, StructField,
                               StructType, TimestampType)

from tidemark.operators.upsert import publish
from tidemark.plans import bookings as B
from tidemark.plans import restaurant as R
from tidemark.plans import retail as W
from tidemark.sources.readers import read_csv, read_dated, write_snappy

S = StringType()
# Fixed schemas of the restaurant source files (column order as delivered).
ORDER_ITEMS = StructType([
    StructField("app_name", S), StructField("restaurant_id", S), StructField("creation_time_utc", TimestampType()),
    StructField("order_id", S), StructField("user_id", S), StructField("printed_card_number", S),
    StructField("is_loyalty", BooleanType()), StructField("currency", S), StructField("lineitem_id", S),
    StructField("item_category", S), StructField("item_name", S), StructField("item_price", DecimalType(10, 2)),
    StructField("item_quantity", IntegerType())])
ORDER_ITEM_OPTIONS = StructType([
    StructField("order_id", S), StructField("lineitem_id", S), StructField("option_group_name", S),
    StructField("option_name", S), StructField("option_price", DecimalType(10, 2)),
    StructField("option_quantity", IntegerType())])
DATE_DIM = StructType([
    StructField("date_key", S), StructField("year", IntegerType()), StructField("month", IntegerType()),
    StructField("week", IntegerType()), StructField("day_of_week", S), StructField("is_weekend", BooleanType()),
    StructField("is_holiday", BooleanType()), StructField("holiday_name", S)])
SPEND_SCHEMA = StructType([StructField("date", S), StructField("channel", S), StructField("spend", DoubleType())])


def sales_fact_job(spark: SparkSession, items_csv: str, options_csv: str, date_dim_csv: str, out_path: str) -> None:
    """Nightly restaurant job: three CSVs -> final fact (CLV + RFM) -> snappy Parquet."""
    items = read_csv(spark, items_csv, ORDER_ITEMS, bool_cols=["is_loyalty"])
    opts = read_csv(spark, options_csv, ORDER_ITEM_OPTIONS)
    cal = read_csv(spark, date_dim_csv, DATE_DIM, bool_cols=["is_weekend", "is_holiday"])
    write_snappy(R.sales_fact_final(items, opts, cal), out_path)


def retail_reports_job(spark: SparkSession, depts, stores, facts, out_root: str, current_only: bool = True) -> dict:
    """The twelve weekly-sales summary tables, each published as a new table version."""
    tables = {
        "weekly_sales_store_holiday": W.sales_store_holiday(depts),
        "weekly_sales_temp_year": W.sales_temp_year(depts, facts, current_only),
        "weekly_sales_store_size": W.sales_store_size(depts, stores),
        "weekly_sales_store_type_month": W.sales_type_month(depts, stores),
        "markdown_sales_year_store": W.markdown_year_store(facts, current_only),
        "weekly_sales_store_type": W.sales_type(depts, stores),
        "fuel_price_store_year": W.fuel_store_year(facts, current_only),
        "weekly_sales_by_day": W.pandas_sum(depts.withColumn("day", F.dayofmonth("date")), ["day"],
                                            "weekly_sales", "weekly_sales_by_day"),
        "weekly_sales_by_month": W.pandas_sum(depts.withColumn("month", F.date_format("date", "MMMM")), ["month"],
                                              "weekly_sales", "weekly_sales_by_month"),
        "weekly_sales_by_year": W.pandas_sum(depts.withColumn("year", F.year("date")), ["year"],
                                             "weekly_sales", "weekly_sales_by_year"),
        "weekly_sales_by_cpi": W.sales_cpi(depts, facts, current_only),
        "department_weekly_sales": W.sales_dept(depts),
    }
    return {name: publish(df, f"{out_root}/{name}") for name, df in tables.items()}


def cost_per_booking_job(spark: SparkSession, silver, spend_template: str, run_date: dt.date, mapping,
                         out_root: str) -> int:
    """Daily gold job: yesterday's spend file x mapped bookings -> cost per booking table (overwrite)."""
    spend = read_dated(spark, spend_template, run_date, SPEND_SCHEMA, out_col="date_parsed")
    spend = spend.withColumn("date", F.date_format("date_parsed", "yyyy-MM-dd")).drop("date_parsed")
    return publish(B.cost_per_booking(spend, silver, mapping), out_root)


# Id columns whose NULL rows are dropped when the file has them.
LANDING_ID_COLUMNS = ["PROVNUM", "CMS Certification Number (CCN)", "State or Nation"]


def csv_landing_job(spark: SparkSession, csv_path: str, dest_root: str) -> str:
    """Land one delivered CSV as partitioned Parquet under ``dest_root/tables/<table>``.

    The table name comes from the file name; columns are read as text (the
    files' layouts differ, and no inference scan is run), rows with NULL ids are
    dropped when those columns exist, strings are trimmed, year / month / day
    come from the file's date column, and rows are appended partitioned by
    them. Returns the table name.
    """
    from tidemark.functions.columns import table_name_from_file
    from tidemark.operators.clean import date_parts, drop_null_if_present, trim_all_strings
    from tidemark.sources.readers import write_partitioned
    name = spark.range(1).select(table_name_from_file(F.lit(csv_path.rstrip("/").split("/")[-1]))
                                 .alias("t")).first()["t"]
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(csv_path)
    df = date_parts(trim_all_strings(drop_null_if_present(df, LANDING_ID_COLUMNS)))
    parts = [c for c in ("year", "month", "day") if c in df.columns]
    write_partitioned(df, f"{dest_root}/tables/{name}", parts, mode="append")
    return name
