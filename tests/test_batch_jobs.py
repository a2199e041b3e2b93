"""End-to-end jobs on files written from the sf0.001 views."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF0
from tidemark.operators.upsert import read_table
from tidemark.plans import batch_jobs as J
from tidemark.plans import restaurant as R
from tidemark.plans.views import v_book, v_cal, v_depts, v_facts, v_items, v_mapping, v_opts, v_spend, v_stores


def test_sales_fact_job_matches_in_memory_build(spark, tmp_path):
    items, opts, cal = v_items(spark, SF0), v_opts(spark, SF0), v_cal(spark, SF0)
    d = {n: str(tmp_path / n) for n in ("items", "opts", "cal", "out")}
    items_csv = items.select(F.lit("app").alias("app_name"), "restaurant_id",
                             F.date_format("creation_time_utc", "yyyy-MM-dd HH:mm:ss").alias("creation_time_utc"),
                             "order_id", "user_id", F.lit("4111").alias("printed_card_number"),
                             F.when(F.col("is_loyalty"), "TRUE").otherwise("FALSE").alias("is_loyalty"),
                             F.lit("USD").alias("currency"), "lineitem_id", "item_category", "item_name",
                             "item_price", "item_quantity")
    items_csv.write.option("header", True).option("lineSep", "\r\n").csv(d["items"])
    opts.select("order_id", "lineitem_id", F.lit("g").alias("option_group_name"), F.lit("o").alias("option_name"),
                "option_price", "option_quantity").write.option("header", True).csv(d["opts"])
    cal.select("date_key", "year", "month", "week", "day_of_week",
               F.when(F.col("is_weekend"), "TRUE").otherwise("FALSE").alias("is_weekend"),
               F.when(F.col("is_holiday"), "TRUE").otherwise("FALSE").alias("is_holiday"),
               "holiday_name").write.option("header", True).csv(d["cal"])
    J.sales_fact_job(spark, d["items"], d["opts"], d["cal"], d["out"])
    got = spark.read.parquet(d["out"])
    exp = R.sales_fact_final(items, opts, cal, materialize_fact=False)
    key = ["order_id", "lineitem_id", "clv_segment_label", "monthly_vip_status", "option_price"]
    assert got.count() == exp.count()
    assert sorted(map(tuple, got.select(*key).collect()), key=repr) == \
        sorted(map(tuple, exp.select(*key).collect()), key=repr)


def test_retail_reports_job_publishes_twelve_tables(spark, tmp_path):
    out = str(tmp_path / "rpt")
    versions = J.retail_reports_job(spark, v_depts(spark, SF0), v_stores(spark, SF0), v_facts(spark, SF0), out)
    assert len(versions) == 12 and set(versions.values()) == {0}
    assert read_table(spark, f"{out}/weekly_sales_store_type").count() == 3


def test_cost_per_booking_job_reads_yesterday(spark, tmp_path):
    root = str(tmp_path / "spend")
    v_spend(spark, SF0).withColumn("file_date", F.col("date")).write.partitionBy("file_date").json(root)
    J.cost_per_booking_job(spark, v_book(spark, SF0), root + "/file_date={date}", dt.date(2024, 1, 11),
                           v_mapping(spark), str(tmp_path / "gold"))
    gold = read_table(spark, str(tmp_path / "gold"))
    assert gold.count() == 3 and {str(r.spend_date) for r in gold.collect()} == {"2024-01-10"}


def test_csv_landing_job(spark, tmp_path):
    src = tmp_path / "Daily Nurse-Staffing Q2.csv"
    src.write_bytes(b"PROVNUM,provider_name,WorkDate,hours\r\n1, Alpha ,20240401,8.5\r\n,Beta,20240402,7\r\n"
                    b"3,Gamma,bad,6\r\n")
    name = J.csv_landing_job(spark, str(src), str(tmp_path / "lake"))
    assert name == "daily_nurse_staffing_q2"
    back = spark.read.parquet(str(tmp_path / "lake" / "tables" / name))
    rows = sorted((r.PROVNUM, r.provider_name, r.year, r.month, r.day) for r in back.collect())
    assert rows == [("1", "Alpha", 2024, 4, 1), ("3", "Gamma", None, None, None)]
