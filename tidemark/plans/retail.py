"""Retail weekly-sales reports (pandas group-by semantics on Spark).

pandas drops NULL group keys and sums an all-NULL group to 0; Spark keeps a
NULL group and returns NULL. Every report here therefore filters NULL keys and
wraps sums in ``coalesce(..., 0)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import exact_sum, mean_of, month_name, range_bin_label
from tidemark.operators.clean import drop_all_null, fill_zero
from tidemark.plans.registry import register
from tidemark.plans.views import v_depts, v_facts, v_stores

MARKDOWNS = [f"markdown_{i}" for i in range(1, 6)]


def pandas_sum(df: DataFrame, keys: list, measure: str, out: str) -> DataFrame:
    """groupBy(keys).sum(measure) with NULL keys dropped and empty sums = 0."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) if isinstance(k, Column) else F.col(k)).isNotNull()
    return (df.filter(cond).groupBy(*keys)
            .agg(F.coalesce(exact_sum(measure), F.lit(0.0)).alias(out)))


def current_facts(facts: DataFrame, current_only: bool = True) -> DataFrame:
    """History rows to join; with ``current_only`` only open (valid_to NULL) rows.

    The reference joins the whole history, so a key with several versions
    multiplies sales; pass ``current_only=False`` to reproduce that.
    """
    if current_only and "valid_to" in facts.columns:
        return facts.filter(F.col("valid_to").isNull())
    return facts


def sales_store_holiday(depts):
    return pandas_sum(depts, ["store_id", "is_holiday"], "weekly_sales", "total_weekly_sales")


def sales_temp_year(depts, facts, current_only=True):
    j = depts.join(current_facts(facts, current_only), on=["store_id", "date"], how="inner")
    j = j.withColumns({"year": F.year("date"), "temp_range": range_bin_label("temperature", 10, True)})
    return pandas_sum(j, ["temp_range", "year"], "weekly_sales", "total_weekly_sales")


def sales_store_size(depts, stores):
    j = depts.join(stores, on="store_id", how="inner")
    j = j.withColumn("store_size_range", range_bin_label("size", 10000, False))
    return pandas_sum(j, ["store_size_range"], "weekly_sales", "total_weekly_sales")


def sales_type_month(depts, stores):
    j = depts.join(stores, on="store_id", how="inner").withColumn("month", month_name("date"))
    return pandas_sum(j, ["type", "month"], "weekly_sales", "total_weekly_sales")


def markdown_year_store(facts, current_only=True):
    f = fill_zero(drop_all_null(current_facts(facts, current_only), MARKDOWNS), MARKDOWNS)
    f = f.withColumn("year", F.year("date")).filter(F.col("store_id").isNotNull())
    return f.groupBy("year", "store_id").agg(
        *[F.coalesce(exact_sum(m), F.lit(0.0)).alias(f"{m}_total_sales") for m in MARKDOWNS])


def sales_type(depts, stores):
    return pandas_sum(depts.join(stores, on="store_id", how="inner"), ["type"], "weekly_sales",
                      "total_weekly_sales")


def fuel_store_year(facts, current_only=True):
    f = current_facts(facts, current_only).withColumn("year", F.year("date"))
    f = f.filter(F.col("store_id").isNotNull() & F.col("year").isNotNull())
    return f.groupBy("store_id", "year").agg(mean_of("fuel_price", 6).alias("average_fuel_cost"))


def sales_by_day_month_year(depts):
    """The three rollups in one scan (GROUPING SETS -> a single Expand)."""
    d = depts.select(F.dayofmonth("date").alias("day"), month_name("date").alias("month"),
                     F.year("date").alias("year"), "weekly_sales")
    g = d.groupingSets([["day"], ["month"], ["year"]], "day", "month", "year").agg(
        F.coalesce(exact_sum("weekly_sales"), F.lit(0.0)).alias("weekly_sales_total"),
        F.grouping("day").alias("_gd"), F.grouping("month").alias("_gm"))
    grain = F.when(F.col("_gd") == 0, "day").when(F.col("_gm") == 0, "month").otherwise("year")
    return g.withColumn("grain", grain).drop("_gd", "_gm")


def sales_cpi(depts, facts, current_only=True):
    j = depts.join(current_facts(facts, current_only), on=["store_id", "date"], how="inner")
    j = j.withColumn("cpi_range", range_bin_label("cpi", 10, True))
    return pandas_sum(j, ["cpi_range"], "weekly_sales", "total_weekly_sales")


def sales_dept(depts):
    return pandas_sum(depts, ["dept_id"], "weekly_sales", "total_weekly_sales")


# ------------------------------------------------------------------ oracle text
D = """v_depts AS (SELECT CAST(l.l_suppkey AS INTEGER) AS store_id, CAST(l.l_linenumber AS INTEGER) AS dept_id,
  CAST(o.o_orderdate AS DATE) AS date,
  CASE WHEN l.l_orderkey % 59 = 0 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(10,2)) END AS weekly_sales,
  CASE WHEN l.l_orderkey % 53 = 0 THEN NULL ELSE l.l_linestatus = 'O' END AS is_holiday
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
S = """v_stores AS (SELECT CAST(s_suppkey AS INTEGER) AS store_id,
  CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS type,
  CAST(30000 + (s_suppkey * 7919) % 190000 AS INTEGER) AS size FROM supplier)"""
FA = """v_facts AS (SELECT store_id, date,
  CAST((store_id * 37 + dayofyear(date) * 13) % 1200 - 200 AS DOUBLE) / 10 AS temperature,
  2.5 + CAST((store_id * 7 + dayofyear(date)) % 160 AS DOUBLE) / 64 AS fuel_price,
  CAST((store_id * 11 + month(date) * 17 + day(date)) % 1000 + 1200 AS DOUBLE) / 10 AS cpi,
  {md}
  FROM (SELECT DISTINCT store_id, date FROM v_depts))"""
_md = []
for _i in range(1, 6):
    _md.append(f"CASE WHEN (store_id + dayofyear(date)) % 11 = 0 OR (store_id + dayofyear(date) + {_i}) % 4 = 0 "
               f"THEN NULL ELSE CAST((store_id * {_i} + day(date) * 3) % 500 AS DOUBLE) * 1.25 END AS markdown_{_i}")
FA = FA.format(md=",\n  ".join(_md))


def _w(*parts):
    return "WITH " + ", ".join(parts) + "\n"


def _bin_sql(col, width, flt):
    lo = f"CAST(floor(round_even(CAST({col} AS DOUBLE), 0) / {width}) * {width} AS BIGINT)"
    if flt:
        return (f"CAST(CAST({lo} AS DOUBLE) AS VARCHAR) || ' to ' || "
                f"CAST(CAST({lo} + {width - 1} AS DOUBLE) AS VARCHAR)")
    return f"CAST({lo} AS VARCHAR) || ' to ' || CAST({lo} + {width - 1} AS VARCHAR)"


SUM_WS = "COALESCE(CAST(SUM(weekly_sales) AS DOUBLE), 0) AS total_weekly_sales"

ORACLES = {
    "rpt_sales_store_holiday": _w(D) + f"SELECT store_id, is_holiday, {SUM_WS} FROM v_depts "
    "WHERE store_id IS NOT NULL AND is_holiday IS NOT NULL GROUP BY store_id, is_holiday",
    "rpt_sales_temp_year": _w(D, FA) + f"SELECT temp_range, year, {SUM_WS} FROM (SELECT "
    f"{_bin_sql('temperature', 10, True)} AS temp_range, CAST(year(d.date) AS INTEGER) AS year, weekly_sales "
    "FROM v_depts d JOIN v_facts f ON d.store_id = f.store_id AND d.date = f.date) "
    "WHERE temp_range IS NOT NULL AND year IS NOT NULL GROUP BY temp_range, year",
    "rpt_sales_store_size": _w(D, S) + f"SELECT store_size_range, {SUM_WS} FROM (SELECT "
    f"{_bin_sql('size', 10000, False)} AS store_size_range, weekly_sales FROM v_depts d JOIN v_stores s "
    "ON d.store_id = s.store_id) WHERE store_size_range IS NOT NULL GROUP BY store_size_range",
    "rpt_sales_type_month": _w(D, S) + f"SELECT type, monthname(date) AS month, {SUM_WS} FROM v_depts d "
    "JOIN v_stores s ON d.store_id = s.store_id WHERE type IS NOT NULL GROUP BY type, monthname(date)",
    "rpt_markdown_year_store": _w(D, FA) + "SELECT CAST(year(date) AS INTEGER) AS year, store_id, "
    + ", ".join(f"COALESCE(CAST(SUM(COALESCE(markdown_{i}, 0)) AS DOUBLE), 0) AS markdown_{i}_total_sales"
                for i in range(1, 6))
    + " FROM v_facts WHERE NOT (markdown_1 IS NULL AND markdown_2 IS NULL AND markdown_3 IS NULL AND "
    "markdown_4 IS NULL AND markdown_5 IS NULL) AND store_id IS NOT NULL GROUP BY year(date), store_id",
    "rpt_sales_type": _w(D, S) + f"SELECT type, {SUM_WS} FROM v_depts d JOIN v_stores s "
    "ON d.store_id = s.store_id WHERE type IS NOT NULL GROUP BY type",
    "rpt_fuel_store_year": _w(D, FA) + "SELECT store_id, CAST(year(date) AS INTEGER) AS year, "
    "CAST(SUM(CAST(fuel_price AS DECIMAL(18,6))) AS DOUBLE) / COUNT(fuel_price) AS average_fuel_cost "
    "FROM v_facts GROUP BY store_id, year(date)",
    "rpt_sales_day": _w(D) + "SELECT CAST(day(date) AS INTEGER) AS day, "
    "COALESCE(CAST(SUM(weekly_sales) AS DOUBLE), 0) AS weekly_sales_by_day FROM v_depts "
    "WHERE date IS NOT NULL GROUP BY day(date)",
    "rpt_sales_month": _w(D) + "SELECT monthname(date) AS month, "
    "COALESCE(CAST(SUM(weekly_sales) AS DOUBLE), 0) AS weekly_sales_by_month FROM v_depts "
    "WHERE date IS NOT NULL GROUP BY monthname(date)",
    "rpt_sales_year": _w(D) + "SELECT CAST(year(date) AS INTEGER) AS year, "
    "COALESCE(CAST(SUM(weekly_sales) AS DOUBLE), 0) AS weekly_sales_by_year FROM v_depts "
    "WHERE date IS NOT NULL GROUP BY year(date)",
    "rpt_sales_cpi": _w(D, FA) + f"SELECT cpi_range, {SUM_WS} FROM (SELECT {_bin_sql('cpi', 10, True)} "
    "AS cpi_range, weekly_sales FROM v_depts d JOIN v_facts f ON d.store_id = f.store_id AND d.date = f.date) "
    "WHERE cpi_range IS NOT NULL GROUP BY cpi_range",
    "rpt_sales_dept": _w(D) + f"SELECT dept_id, {SUM_WS} FROM v_depts WHERE dept_id IS NOT NULL GROUP BY dept_id",
    "day_month_year_sums": _w(D) + "SELECT day, month, year, weekly_sales_total, grain FROM ("
    "SELECT CAST(day(date) AS INTEGER) AS day, monthname(date) AS month, CAST(year(date) AS INTEGER) AS year, "
    "COALESCE(CAST(SUM(weekly_sales) AS DOUBLE), 0) AS weekly_sales_total, "
    "CASE WHEN GROUPING(day(date)) = 0 THEN 'day' WHEN GROUPING(monthname(date)) = 0 THEN 'month' "
    "ELSE 'year' END AS grain FROM v_depts GROUP BY GROUPING SETS ((day(date)), (monthname(date)), (year(date))))",
}
ORACLES["range_bin"] = _w(D, FA) + (
    f"SELECT store_id, date, temperature, {_bin_sql('temperature', 10, True)} AS temp_range, cpi, {_bin_sql('cpi', 10, True)} AS cpi_range "
    "FROM v_facts")
ORACLES["ordered_report"] = _w(S) + (
    f"SELECT {_bin_sql('size', 10000, False)} AS store_size_range, type, COUNT(*) AS stores, CAST(SUM(size) AS BIGINT) AS total_size "
    "FROM v_stores GROUP BY ALL")


def binned_facts(facts: DataFrame) -> DataFrame:
    """Every fact row with the bins of its temperature and CPI."""
    bins = {"temp_range": range_bin_label("temperature", 10, True), "cpi_range": range_bin_label("cpi", 10, True)}
    return facts.withColumns(bins).select("store_id", "date", "temperature", "temp_range", "cpi", "cpi_range")


def stores_by_size(stores: DataFrame) -> DataFrame:
    """Stores and floor space per size bin and type, in the order of the bins' lower bounds, the larger count first."""
    g = stores.groupBy(range_bin_label("size", 10000, False).alias("store_size_range"), "type").agg(
        F.count(F.lit(1)).alias("stores"), F.sum(F.col("size").cast("bigint")).alias("total_size"))
    return g.orderBy(F.split("store_size_range", " ").getItem(0).cast("bigint"), F.desc("stores"), "type")


def _d(spark, sf):
    return v_depts(spark, sf)


_Q = {
    "rpt_sales_store_holiday": lambda s, sf: sales_store_holiday(_d(s, sf)),
    "rpt_sales_temp_year": lambda s, sf: sales_temp_year(_d(s, sf), v_facts(s, sf)),
    "rpt_sales_store_size": lambda s, sf: sales_store_size(_d(s, sf), v_stores(s, sf)),
    "rpt_sales_type_month": lambda s, sf: sales_type_month(_d(s, sf), v_stores(s, sf)),
    "rpt_markdown_year_store": lambda s, sf: markdown_year_store(v_facts(s, sf)),
    "rpt_sales_type": lambda s, sf: sales_type(_d(s, sf), v_stores(s, sf)),
    "rpt_fuel_store_year": lambda s, sf: fuel_store_year(v_facts(s, sf)),
    "rpt_sales_day": lambda s, sf: pandas_sum(
        _d(s, sf).withColumn("day", F.dayofmonth("date")), ["day"], "weekly_sales", "weekly_sales_by_day"),
    "rpt_sales_month": lambda s, sf: pandas_sum(
        _d(s, sf).withColumn("month", month_name("date")), ["month"], "weekly_sales", "weekly_sales_by_month"),
    "rpt_sales_year": lambda s, sf: pandas_sum(
        _d(s, sf).withColumn("year", F.year("date")), ["year"], "weekly_sales", "weekly_sales_by_year"),
    "rpt_sales_cpi": lambda s, sf: sales_cpi(_d(s, sf), v_facts(s, sf)),
    "rpt_sales_dept": lambda s, sf: sales_dept(_d(s, sf)),
    "day_month_year_sums": lambda s, sf: sales_by_day_month_year(_d(s, sf)),
    "range_bin": lambda s, sf: binned_facts(v_facts(s, sf)),
    "ordered_report": lambda s, sf: stores_by_size(v_stores(s, sf)),
}
for _k, _f in _Q.items():
    register(_k, ORACLES[_k])(_f)
