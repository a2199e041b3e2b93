"""Restaurant metric keys and dashboard reports over the final sales fact.

Dashboard queries in the reference take a (year, month) parameter. The
registered keys answer every period at once (grouped by year and month), so
they read the whole fact; :func:`for_period` applies the parameter filter for
an interactive caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import exact_sum, mean_of, season
from tidemark.operators.materialize import materialize
from tidemark.operators.ntile import global_ntile
from tidemark.operators.ranking import gap_days, top_k
from tidemark.plans import restaurant as R
from tidemark.plans.oracle_views import RESTAURANT, with_views
from tidemark.plans.registry import register
from tidemark.plans.views import v_cal, v_items, v_opts
from tidemark.sources import fs

_FACT_CACHE: dict = {}
REV_SQL = "(item_price * item_quantity + option_price * option_quantity)"
GAP_TIEBREAK = ["order_id", "lineitem_id", "restaurant_id"]


def _place(spark, sf_dir, what: str) -> tuple:
    return spark.sparkContext.applicationId, sf_dir, fs.stamp(spark, sf_dir), what


def _once(spark, sf_dir, what: str, build) -> DataFrame:
    """``build()``, kept for the application and the input files as they are: new or changed files build it anew."""
    key = _place(spark, sf_dir, what)
    if key not in _FACT_CACHE:
        _FACT_CACHE[key] = build()
    return _FACT_CACHE[key]


def base_fact(spark, sf_dir) -> DataFrame:
    """The cleaned, joined sales fact for ``sf_dir``, written once and reused."""
    return _once(spark, sf_dir, "base", lambda: materialize(
        R.sales_fact(v_items(spark, sf_dir), v_opts(spark, sf_dir), v_cal(spark, sf_dir)), "sales_fact"))


def fact_once(spark, sf_dir) -> DataFrame:
    """The base fact for a query that reads few of its columns, once: the written fact if there is one, else its joins
    without the other columns, not written."""
    key = _place(spark, sf_dir, "base")
    return _FACT_CACHE[key] if key in _FACT_CACHE else R.sales_fact(v_items(spark, sf_dir), v_opts(spark, sf_dir), v_cal(spark, sf_dir))


def user_months(spark, sf_dir) -> DataFrame:
    """The user-months of the base fact, written once and reused."""
    return _once(spark, sf_dir, "months", lambda: materialize(R.user_months(fact_once(spark, sf_dir)), "user_months"))


def final_plan(spark, sf_dir) -> DataFrame:
    """The final fact (with CLV and RFM) for ``sf_dir``, not written; its CLV and RFM tables are built once."""
    return _once(spark, sf_dir, "plan", lambda: R.final_from_fact(base_fact(spark, sf_dir)))


def final_fact(spark, sf_dir, *cols: str) -> DataFrame:
    """The final fact for a report: its joins carry the columns the report reads, and no others.

    With ``cols``, the rows of these columns are written, for a report that reads them several times.
    """
    fact = final_plan(spark, sf_dir)
    return materialize(fact.select(*cols), "final_cols") if cols else fact


def for_period(df: DataFrame, year: int, month: int | None = None) -> DataFrame:
    cond = F.col("year") == year
    if month is not None:
        cond = cond & (F.col("month") == month)
    return df.filter(cond)


def sql(select: str) -> str:
    return with_views(RESTAURANT, select)


REV = R.line_revenue


# ---------------------------------------------------------------- fact, CLV, RFM
FACT_BASE_COLS = ("order_id, lineitem_id, user_id, restaurant_id, creation_time_utc, item_category, "
                  "item_name, item_price, item_quantity, is_loyalty, date_key, option_price, "
                  "option_quantity, year, month, week, day_of_week, is_weekend, is_holiday, "
                  "holiday_name, day")


@register("sales_fact", sql(f"SELECT {FACT_BASE_COLS} FROM v_fact_base"))
def q_sales_fact(spark, sf):
    return base_fact(spark, sf)


@register("order_revenue", sql(
    "SELECT order_id, user_id, creation_time_utc, CAST(base_revenue AS DOUBLE) AS base_revenue, "
    "CAST(options_revenue AS DOUBLE) AS options_revenue, CAST(total_revenue AS DOUBLE) AS total_revenue "
    "FROM v_order_rev"))
def q_order_revenue(spark, sf):
    o = R.order_revenue(fact_once(spark, sf))
    return o.select("order_id", "user_id", "creation_time_utc",
                    *[F.col(c).cast("double").alias(c)
                      for c in ("base_revenue", "options_revenue", "total_revenue")])


@register("user_history", sql("SELECT * FROM v_hist"))
def q_user_history(spark, sf):
    return R.user_history(fact_once(spark, sf))


@register("global_means", sql("SELECT * FROM v_glob"))
def q_global_means(spark, sf):
    return R.global_means(R.user_history(fact_once(spark, sf)))


@register("clv", sql("SELECT * FROM v_clv"))
def q_clv(spark, sf):
    return R.clv(fact_once(spark, sf))


@register("clv_segment", sql("SELECT * FROM v_clv_seg"))
def q_clv_segment(spark, sf):
    return R.clv_segment(R.clv(fact_once(spark, sf)))


@register("ntile5_global", sql(
    "SELECT user_id, customer_lifetime_value, CAST(NTILE(5) OVER (ORDER BY customer_lifetime_value, user_id) "
    "AS INTEGER) AS clv_tile FROM v_clv"))
def q_ntile5(spark, sf):
    base = materialize(R.clv(fact_once(spark, sf)).select("user_id", "customer_lifetime_value"), "n5")
    return global_ntile(base, 5, ["customer_lifetime_value", "user_id"], out="clv_tile")


@register("user_recency", sql("SELECT * FROM v_recency"))
def q_user_recency(spark, sf):
    return R.user_recency(user_months(spark, sf), "_last")


@register("user_month_stats", sql("SELECT * FROM v_month_stats"))
def q_user_month_stats(spark, sf):
    return R.user_month_stats(fact_once(spark, sf))


@register("left_join_attach", sql(
    "SELECT m.*, r.days_since_last_order FROM v_month_stats m LEFT JOIN v_recency r USING (user_id)"))
def q_left_join_attach(spark, sf):
    months = user_months(spark, sf)
    return months.drop("_last").join(R.user_recency(months, "_last"), on="user_id", how="left")


RFM_COLS = ("user_id, year, month, monthly_order_count, monthly_revenue, days_since_last_order, "
            "monthly_recency_score, monthly_frequency_score, monthly_monetary_score")


@register("rfm_scores", sql(f"SELECT {RFM_COLS} FROM v_rfm"))
def q_rfm_scores(spark, sf):
    return R.score_labels(R.month_tiles(user_months(spark, sf)))


@register("ntile2_rfm", sql(f"SELECT {RFM_COLS}, " + ", ".join(
    f"CASE WHEN {c} = 'Low' THEN 1 ELSE 2 END AS {c.replace('score', 'half')}" for c in R.SCORES) + " FROM v_rfm"))
def q_ntile2_rfm(spark, sf):
    """Measures, scores and the three halves as numbers. Small brackets, so several rounds of the selection are exercised by the oracle."""
    t = R.month_tiles(user_months(spark, sf), held=3_000, sample=1_000)
    halves = t.withColumns({c.replace("score", "half"): F.col(c) for c in R.SCORES})
    return R.score_labels(halves).select(*RFM_COLS.split(", "), *[c.replace("score", "half") for c in R.SCORES])


@register("rfm_status", sql("SELECT * FROM v_rfm"))
def q_rfm_status(spark, sf):
    return R.rfm_status(R.score_labels(R.month_tiles(user_months(spark, sf))))


@register("sales_fact_final", sql("SELECT * FROM v_fact"))
def q_sales_fact_final(spark, sf):
    return final_plan(spark, sf)


@register("inner_join_multi", sql("SELECT * FROM v_fact"))
def q_inner_join_multi(spark, sf):
    """Fact rows joined to their user's CLV and segment (one key) and their user-month's RFM scores and status (three keys)."""
    return final_plan(spark, sf)


# ---------------------------------------------------------------- revenue by flag
def _rev_by(flag: str, label: str, yes: str, no: str, alias: str | None = None):
    name = alias or flag

    def q(spark, sf):
        f = final_fact(spark, sf)
        out = f.groupBy("year", "month", F.col(flag).alias(name)).agg(exact_sum(REV()).alias("revenue"))
        return out.withColumn(label, F.when(F.col(name), yes).otherwise(no))

    o = sql(f"SELECT year, month, {flag} AS {name}, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue, "
            f"CASE WHEN {flag} THEN '{yes}' ELSE '{no}' END AS {label} "
            f"FROM v_fact GROUP BY year, month, {flag}")
    return q, o


for _key, _args in {
    "rev_by_loyalty": ("is_loyalty", "loyalty", "Loyal", "Non-Loyal"),
    "rev_by_vip": ("monthly_vip_status", "vip_label", "VIP", "Non-VIP", "vip_status"),
    "rev_by_new": ("monthly_new_customer_status", "new_label", "New Customers", "Old Customers",
                   "new_customer_status"),
    "rev_by_churn": ("monthly_churn_risk_status", "churn_label", "At Risk", "Regular", "churn_risk"),
}.items():
    _q, _o = _rev_by(*_args)
    register(_key, _o)(_q)


@register("rev_by_clv", sql(
    f"SELECT year, month, clv_segment_label AS clv_segment, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue "
    "FROM v_fact GROUP BY year, month, clv_segment_label"))
def q_rev_by_clv(spark, sf):
    return (final_fact(spark, sf).groupBy("year", "month", F.col("clv_segment_label").alias("clv_segment"))
            .agg(exact_sum(REV()).alias("revenue")))


@register("share_of_total", sql(
    f"SELECT year, month, clv_segment_label AS clv_segment, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue, "
    f"CAST(SUM{REV_SQL} AS DOUBLE) / CAST(SUM(SUM{REV_SQL}) OVER (PARTITION BY year, month) AS DOUBLE) AS share "
    "FROM v_fact GROUP BY year, month, clv_segment_label"))
def q_share_of_total(spark, sf):
    g = (final_fact(spark, sf).groupBy("year", "month", F.col("clv_segment_label").alias("clv_segment"))
         .agg(F.sum(REV().cast("decimal(18,2)")).alias("_rev")))
    w = Window.partitionBy("year", "month")
    return g.select("year", "month", "clv_segment", F.col("_rev").cast("double").alias("revenue"),
                    (F.col("_rev").cast("double") / F.sum("_rev").over(w).cast("double")).alias("share"))


@register("dslo_by_churn", sql(
    "SELECT year, month, monthly_churn_risk_status AS churn_risk, AVG(days_since_last_order) AS avg_dslo "
    "FROM v_fact GROUP BY year, month, monthly_churn_risk_status"))
def q_dslo_by_churn(spark, sf):
    return (final_fact(spark, sf).groupBy("year", "month", F.col("monthly_churn_risk_status").alias("churn_risk"))
            .agg(F.avg("days_since_last_order").alias("avg_dslo")))


# ---------------------------------------------------------------- order gaps (lag)
GAP_SQL = ("CAST(date_diff('day', LAG(date_key) OVER (PARTITION BY user_id ORDER BY date_key, order_id, "
           "lineitem_id, restaurant_id), date_key) AS INTEGER)")


GAP_DIMS = ["year", "month", "monthly_churn_risk_status", "is_loyalty", "restaurant_id"]


def gapped(spark, sf) -> DataFrame:
    """Days between orders per fact row with what the reports group by; dealt on these narrow rows once, for all of them."""
    cols = list(dict.fromkeys(["user_id", "date_key", *GAP_TIEBREAK, *GAP_DIMS]))
    return _once(spark, sf, "gaps", lambda: materialize(
        gap_days(final_fact(spark, sf, *cols), "user_id", "date_key", GAP_TIEBREAK), "gaps"))


def _gap_by(dim: str, name: str):
    def q(spark, sf):
        return (gapped(spark, sf).groupBy("year", "month", F.col(dim).alias(name))
                .agg(F.avg("days_between_orders").alias("avg_order_gap_days")))
    o = sql(f"SELECT year, month, {dim} AS {name}, AVG(g) AS avg_order_gap_days FROM "
            f"(SELECT *, {GAP_SQL} AS g FROM v_fact) GROUP BY year, month, {dim}")
    return q, o


for _key, _args in {"gap_by_churn": ("monthly_churn_risk_status", "churn_risk"),
                    "gap_by_loyalty": ("is_loyalty", "is_loyalty")}.items():
    _q, _o = _gap_by(*_args)
    register(_key, _o)(_q)


@register("lag_gap_rows", sql(
    f"SELECT user_id, order_id, lineitem_id, restaurant_id, date_key, {GAP_SQL} AS days_between_orders "
    "FROM v_fact"))
def q_lag_gap_rows(spark, sf):
    return gapped(spark, sf).select("user_id", "order_id", "lineitem_id", "restaurant_id", "date_key", "days_between_orders")


@register("lag_gap_orders", sql(
    "SELECT order_id, user_id, date_key, CAST(date_diff('day', LAG(date_key) OVER (PARTITION BY user_id "
    "ORDER BY date_key, order_id), date_key) AS INTEGER) AS days_between_orders "
    "FROM (SELECT DISTINCT order_id, user_id, date_key FROM v_fact)"))
def q_lag_gap_orders(spark, sf):
    o = final_fact(spark, sf).select("order_id", "user_id", "date_key").distinct()
    return gap_days(materialize(o, "order_days"), "user_id", "date_key", ["order_id"])


# ---------------------------------------------------------------- KPIs and trends
@register("rev_year", sql(f"SELECT year, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue FROM v_fact GROUP BY year"))
def q_rev_year(spark, sf):
    return final_fact(spark, sf).groupBy("year").agg(exact_sum(REV()).alias("revenue"))


_MONTH_SQL = sql(f"SELECT year, month, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue FROM v_fact GROUP BY year, month")


@register("rev_month", _MONTH_SQL)
def q_rev_month(spark, sf):
    return final_fact(spark, sf).groupBy("year", "month").agg(exact_sum(REV()).alias("revenue"))


@register("trend_year", _MONTH_SQL)
def q_trend_year(spark, sf):
    return q_rev_month(spark, sf).orderBy("year", "month")


@register("trend_month", sql(
    f"SELECT year, month, day, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue FROM v_fact GROUP BY year, month, day"))
def q_trend_month(spark, sf):
    return (final_fact(spark, sf).groupBy("year", "month", "day").agg(exact_sum(REV()).alias("revenue"))
            .orderBy("year", "month", "day"))


@register("trend_category_year", sql(
    f"SELECT year, month, item_category, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue FROM v_fact "
    "GROUP BY year, month, item_category"))
def q_trend_category_year(spark, sf):
    return (final_fact(spark, sf).groupBy("year", "month", "item_category")
            .agg(exact_sum(REV()).alias("revenue")).orderBy("item_category", "year", "month"))


@register("trend_category_month", sql(
    f"SELECT year, month, day, item_category, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue FROM v_fact "
    "GROUP BY year, month, day, item_category"))
def q_trend_category_month(spark, sf):
    return (final_fact(spark, sf).groupBy("year", "month", "day", "item_category")
            .agg(exact_sum(REV()).alias("revenue")).orderBy("item_category", "year", "month", "day"))


def _top_product(group):
    def q(spark, sf):
        g = final_fact(spark, sf).groupBy(*group, "item_category").agg(exact_sum(REV()).alias("revenue"))
        return top_k(g, "revenue", 1, desc=True, tiebreak=["item_category"], group=group, rank_col=None)
    gl = ", ".join(group)
    o = sql(f"SELECT {gl}, item_category, revenue FROM (SELECT {gl}, item_category, "
            f"CAST(SUM{REV_SQL} AS DOUBLE) AS revenue FROM v_fact GROUP BY {gl}, item_category) "
            f"QUALIFY row_number() OVER (PARTITION BY {gl} ORDER BY revenue DESC NULLS LAST, item_category) = 1")
    return q, o


for _key, _grp in {"top_product_year": ["year"], "top_product_month": ["year", "month"]}.items():
    _q, _o = _top_product(_grp)
    register(_key, _o)(_q)


@register("seasonal_revenue", sql(
    "SELECT year, CASE WHEN month <= 3 THEN 'Winter' WHEN month <= 6 THEN 'Spring' WHEN month <= 9 "
    f"THEN 'Summer' ELSE 'Fall' END AS season, CAST(SUM{REV_SQL} AS DOUBLE) AS seasonal_revenue "
    "FROM v_fact GROUP BY ALL"))
def q_seasonal(spark, sf):
    return (final_fact(spark, sf).groupBy("year", season("month").alias("season"))
            .agg(exact_sum(REV()).alias("seasonal_revenue")))


@register("loyalty_by_clv", sql(
    "SELECT year, month, clv_segment_label AS clv_segment, is_loyalty, COUNT(clv_segment_label) "
    "AS clv_segment_count FROM v_fact GROUP BY year, month, clv_segment_label, is_loyalty"))
def q_loyalty_by_clv(spark, sf):
    return (final_fact(spark, sf)
            .groupBy("year", "month", F.col("clv_segment_label").alias("clv_segment"), "is_loyalty")
            .agg(F.count("clv_segment_label").alias("clv_segment_count")))


def _order_values(f: DataFrame, dim: str) -> DataFrame:
    return f.groupBy("year", "month", "order_id", dim).agg(
        F.sum(REV().cast("decimal(18,2)")).alias("order_revenue"))


@register("aov_by_loyalty", sql(
    f"SELECT year, month, is_loyalty, CAST(SUM(r) AS DOUBLE) / COUNT(r) AS avg_order_value FROM "
    f"(SELECT year, month, order_id, is_loyalty, SUM{REV_SQL} AS r FROM v_fact GROUP BY ALL) "
    "GROUP BY year, month, is_loyalty"))
def q_aov_by_loyalty(spark, sf):
    return (_order_values(final_fact(spark, sf), "is_loyalty").groupBy("year", "month", "is_loyalty")
            .agg(mean_of("order_revenue").alias("avg_order_value")))


@register("two_level_agg", sql(
    f"SELECT year, month, restaurant_id, MAX(d) AS max_daily_revenue FROM "
    f"(SELECT year, month, restaurant_id, day, CAST(SUM{REV_SQL} AS DOUBLE) AS d FROM v_fact GROUP BY ALL) "
    "GROUP BY year, month, restaurant_id"))
def q_two_level(spark, sf):
    d = (final_fact(spark, sf).groupBy("year", "month", "restaurant_id", "day")
         .agg(exact_sum(REV()).alias("d")))
    return d.groupBy("year", "month", "restaurant_id").agg(F.max("d").alias("max_daily_revenue"))


# ---------------------------------------------------------------- location top / bottom 10
def _loc_metric(kind: str):
    if kind == "rev":
        def m(spark, sf):
            return (final_fact(spark, sf).groupBy("year", "month", "restaurant_id")
                    .agg(exact_sum(REV()).alias("total_revenue")))
        msql = (f"SELECT year, month, restaurant_id, CAST(SUM{REV_SQL} AS DOUBLE) AS total_revenue "
                "FROM v_fact GROUP BY ALL")
        return m, msql, "total_revenue"
    if kind == "aov":
        def m(spark, sf):
            return (_order_values(final_fact(spark, sf), "restaurant_id")
                    .groupBy("year", "month", "restaurant_id")
                    .agg(mean_of("order_revenue").alias("avg_order_value")))
        msql = (f"SELECT year, month, restaurant_id, CAST(SUM(r) AS DOUBLE) / COUNT(r) AS avg_order_value "
                f"FROM (SELECT year, month, order_id, restaurant_id, SUM{REV_SQL} AS r FROM v_fact "
                "GROUP BY ALL) GROUP BY ALL")
        return m, msql, "avg_order_value"
    if kind == "gap":
        def m(spark, sf):
            return (gapped(spark, sf).groupBy("year", "month", "restaurant_id")
                    .agg(F.avg("days_between_orders").alias("avg_order_gap_days")))
        msql = (f"SELECT year, month, restaurant_id, AVG(g) AS avg_order_gap_days FROM "
                f"(SELECT *, {GAP_SQL} AS g FROM v_fact) GROUP BY ALL")
        return m, msql, "avg_order_gap_days"

    def m(spark, sf):
        return q_two_level(spark, sf)
    msql = (f"SELECT year, month, restaurant_id, MAX(d) AS max_daily_revenue FROM "
            f"(SELECT year, month, restaurant_id, day, CAST(SUM{REV_SQL} AS DOUBLE) AS d FROM v_fact "
            "GROUP BY ALL) GROUP BY ALL")
    return m, msql, "max_daily_revenue"


for _kind, _name in (("rev", "loc_rev"), ("aov", "loc_aov"), ("gap", "loc_gap"), ("maxday", "loc_maxday")):
    _m, _msql, _col = _loc_metric(_kind)
    for _desc, _suffix in ((True, "top"), (False, "bottom")):
        def _q(spark, sf, _m=_m, _col=_col, _desc=_desc):
            return top_k(_m(spark, sf), _col, 10, desc=_desc, tiebreak=["restaurant_id"],
                         group=["year", "month"])
        _dir = "DESC" if _desc else "ASC"
        _o = sql(f"SELECT *, CAST(row_number() OVER (PARTITION BY year, month ORDER BY {_col} {_dir} NULLS LAST, "
                 f"restaurant_id) AS INTEGER) AS rank FROM ({_msql}) QUALIFY rank <= 10")
        register(f"{_name}_{_suffix}", _o)(_q)


@register("rank_locations", sql(
    "SELECT *, CAST(rank() OVER (PARTITION BY year, month ORDER BY total_revenue DESC) AS INTEGER) "
    f"AS revenue_rank FROM (SELECT year, month, restaurant_id, CAST(SUM{REV_SQL} AS DOUBLE) AS total_revenue "
    "FROM v_fact GROUP BY year, month, restaurant_id)"))
def q_rank_locations(spark, sf):
    m = _loc_metric("rev")[0](spark, sf)
    w = Window.partitionBy("year", "month").orderBy(F.col("total_revenue").desc())
    return m.withColumn("revenue_rank", F.rank().over(w))


# ---------------------------------------------------------------- prices
@register("global_extrema", sql(
    "SELECT year, month, MAX(CAST(item_price AS DOUBLE)) AS max_price, "
    "(SELECT MIN(CAST(item_price AS DOUBLE)) FROM v_fact) AS min_price_all FROM v_fact GROUP BY year, month"))
def q_global_extrema(spark, sf):
    f = final_fact(spark, sf, "year", "month", "item_price")
    overall = f.agg(F.min(F.col("item_price").cast("double")).alias("min_price_all"))
    per = f.groupBy("year", "month").agg(F.max(F.col("item_price").cast("double")).alias("max_price"))
    return R.attach_scalar(per, overall)


PRICE_ORDER = ["item_price", "item_quantity", "option_price", "option_quantity"]


@register("price_deciles", sql(
    f"SELECT year, month, price_bucket, CAST(SUM{REV_SQL} AS DOUBLE) AS bucket_revenue FROM "
    "(SELECT *, CAST(NTILE(10) OVER (PARTITION BY year, month ORDER BY item_price, item_quantity, option_price, "
    "option_quantity) AS INTEGER) AS price_bucket FROM v_fact) GROUP BY year, month, price_bucket"))
def q_price_deciles(spark, sf):
    f = final_fact(spark, sf, "year", "month", *PRICE_ORDER, *GAP_TIEBREAK)
    t = global_ntile(f, 10, PRICE_ORDER + GAP_TIEBREAK, out="price_bucket", partition_by=["year", "month"])
    return (t.groupBy("year", "month", "price_bucket").agg(exact_sum(REV()).alias("bucket_revenue"))
            .orderBy("bucket_revenue"))


@register("ntile10_price", sql(
    "SELECT year, month, price_bucket, COUNT(*) AS n_rows, MIN(CAST(item_price AS DOUBLE)) AS min_price, "
    "MAX(CAST(item_price AS DOUBLE)) AS max_price FROM (SELECT *, CAST(NTILE(10) OVER (PARTITION BY year, month "
    "ORDER BY item_price, item_quantity, option_price, option_quantity) AS INTEGER) AS price_bucket FROM v_fact) "
    "GROUP BY ALL"))
def q_ntile10(spark, sf):
    f = final_fact(spark, sf, "year", "month", *PRICE_ORDER, *GAP_TIEBREAK)
    # Small ranges here, so the carry of a month across ranges is exercised by the oracle.
    t = global_ntile(f, 10, PRICE_ORDER + GAP_TIEBREAK, out="price_bucket", partition_by=["year", "month"],
                     rows_per_bucket=5_000)
    return t.groupBy("year", "month", "price_bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.col("item_price").cast("double")).alias("min_price"),
        F.max(F.col("item_price").cast("double")).alias("max_price"))


@register("price_bucket_100", sql(
    "SELECT year, month, CAST(floor(item_price / 100) * 100 AS BIGINT) AS price_bucket_100, "
    f"CAST(SUM{REV_SQL} AS DOUBLE) AS bucket_revenue FROM v_fact GROUP BY ALL"))
def q_price_bucket_100(spark, sf):
    f = final_fact(spark, sf)
    b = (F.floor(F.col("item_price") / 100) * 100).cast("bigint")
    return f.groupBy("year", "month", b.alias("price_bucket_100")).agg(exact_sum(REV()).alias("bucket_revenue"))


# ---------------------------------------------------------------- described-only reports
@register("at_risk_45d", sql(
    "SELECT user_id, days_since_last_order, days_since_last_order > 45 AS at_risk FROM v_recency"))
def q_at_risk(spark, sf):
    r = R.user_recency(user_months(spark, sf), "_last")
    return r.withColumn("at_risk", F.col("days_since_last_order") > 45)


# Period -> its columns; dimension -> its column. Every period meets every dimension.
PERIODS = {"day": ["date_key"], "week": ["year", "week"], "month": ["year", "month"]}
DIMENSIONS = {"location": "restaurant_id", "category": "item_category", "hour": "hour", "holiday": "is_holiday"}
BREAKDOWNS = {f"{p}_{d}": [*pc, dc] for p, pc in PERIODS.items() for d, dc in DIMENSIONS.items()}
_BREAKDOWN_COLS = ["date_key", "year", "week", "month", *DIMENSIONS.values()]
_BREAKDOWN_SQL = "\nUNION ALL\n".join(
    "SELECT " + ", ".join(c if c in cols else f"NULL AS {c}" for c in _BREAKDOWN_COLS)
    + f", CAST(SUM{REV_SQL} AS DOUBLE) AS revenue, '{grain}' AS grain FROM f GROUP BY {', '.join(cols)}"
    for grain, cols in BREAKDOWNS.items())


@register("rev_breakdown", sql(
    "SELECT * FROM (WITH f AS (SELECT *, CAST(hour(creation_time_utc) AS INTEGER) AS hour FROM v_fact) "
    f"{_BREAKDOWN_SQL})"))
def q_rev_breakdown(spark, sf):
    """Revenue by {day, week, month} x {location, category, hour, holiday}: twelve grouping sets over one scan of the fact."""
    f = final_fact(spark, sf).withColumn("hour", F.hour("creation_time_utc"))
    g = f.groupingSets(list(BREAKDOWNS.values()), *_BREAKDOWN_COLS).agg(
        exact_sum(REV()).alias("revenue"), *[F.grouping(c).alias(f"_no_{c}") for c in _BREAKDOWN_COLS])
    period = F.when(F.col("_no_date_key") == 0, "day").when(F.col("_no_week") == 0, "week").otherwise("month")
    dimension = F.coalesce(*[F.when(F.col(f"_no_{c}") == 0, d) for d, c in DIMENSIONS.items()])
    return g.withColumn("grain", F.concat(period, F.lit("_"), dimension)).select(*_BREAKDOWN_COLS, "revenue", "grain")


@register("repeat_orders_by_loyalty", sql(
    "SELECT is_loyalty, COUNT(*) AS n_customers, CAST(SUM(spend) AS DOUBLE) / COUNT(*) AS avg_spend, "
    "AVG(n_orders - 1) AS avg_repeat_orders, "
    "CAST(SUM(CAST(clv AS DECIMAL(18,4))) AS DOUBLE) / COUNT(clv) AS avg_clv FROM "
    f"(SELECT user_id, is_loyalty, SUM{REV_SQL} AS spend, COUNT(DISTINCT order_id) AS n_orders, "
    "MAX(customer_lifetime_value) AS clv FROM v_fact GROUP BY user_id, is_loyalty) GROUP BY is_loyalty"))
def q_repeat_orders(spark, sf):
    per = final_fact(spark, sf).groupBy("user_id", "is_loyalty").agg(
        F.sum(REV().cast("decimal(18,2)")).alias("spend"), F.countDistinct("order_id").alias("n_orders"),
        F.max("customer_lifetime_value").alias("clv"))
    return per.groupBy("is_loyalty").agg(
        F.count(F.lit(1)).alias("n_customers"), mean_of("spend").alias("avg_spend"),
        F.avg(F.col("n_orders") - 1).alias("avg_repeat_orders"), mean_of("clv", 4).alias("avg_clv"))


@register("orders_per_period_loc", sql(
    "SELECT restaurant_id, year, week, COUNT(DISTINCT order_id) AS n_orders, COUNT(DISTINCT date_key) AS "
    "n_days, CAST(COUNT(DISTINCT order_id) AS DOUBLE) / COUNT(DISTINCT date_key) AS orders_per_day "
    "FROM v_fact GROUP BY restaurant_id, year, week"))
def q_orders_per_period(spark, sf):
    g = final_fact(spark, sf).groupBy("restaurant_id", "year", "week").agg(
        F.countDistinct("order_id").alias("n_orders"), F.countDistinct("date_key").alias("n_days"))
    return g.withColumn("orders_per_day", F.col("n_orders").cast("double") / F.col("n_days"))


@register("discount_split", sql(
    "SELECT has_discount, COUNT(*) AS n_orders, CAST(SUM(r) AS DOUBLE) AS revenue FROM "
    f"(SELECT order_id, MAX(option_price < 0) AS has_discount, SUM{REV_SQL} AS r FROM v_fact "
    "GROUP BY order_id) GROUP BY has_discount"))
def q_discount_split(spark, sf):
    per = final_fact(spark, sf).groupBy("order_id").agg(
        F.max(F.col("option_price") < 0).alias("has_discount"),
        F.sum(REV().cast("decimal(18,2)")).alias("r"))
    return per.groupBy("has_discount").agg(F.count(F.lit(1)).alias("n_orders"),
                                           F.sum("r").cast("double").alias("revenue"))


@register("spend_change_pct", sql(
    "SELECT user_id, year, month, monthly_revenue, prev, CASE WHEN prev = 0 THEN NULL "
    "ELSE (monthly_revenue - prev) / prev * 100 END AS pct_change FROM (SELECT user_id, year, month, "
    "monthly_revenue, LAG(monthly_revenue, 1) OVER (PARTITION BY user_id ORDER BY year, month) AS prev "
    "FROM v_month_stats)"))
def q_spend_change(spark, sf, periods: int = 1):
    m = user_months(spark, sf).drop("_last")
    w = Window.partitionBy("user_id").orderBy("year", "month")
    m = m.withColumn("prev", F.lag("monthly_revenue", periods).over(w))
    return m.select("user_id", "year", "month", "monthly_revenue", "prev",
                    (F.try_divide(F.col("monthly_revenue") - F.col("prev"), F.col("prev")) * 100)
                    .alias("pct_change"))


@register("distinct_sorted", sql(
    "SELECT DISTINCT year, month, item_category FROM v_fact ORDER BY year, month, item_category"))
def q_distinct_sorted(spark, sf):
    return final_fact(spark, sf).select("year", "month", "item_category").distinct().orderBy(
        "year", "month", "item_category")


@register("param_filter", sql(
    f"SELECT item_category, CAST(SUM{REV_SQL} AS DOUBLE) AS revenue FROM v_fact "
    "WHERE year = 1998 AND month = 6 GROUP BY item_category"))
def q_param_filter(spark, sf, year: int = 1998, month: int = 6):
    """The dashboard's parameterised query: named parameter markers, no string formatting."""
    return spark.sql(
        "SELECT item_category, CAST(SUM(CAST(item_price * item_quantity + option_price * option_quantity "
        "AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM {fact} WHERE year = :y AND month = :m "
        "GROUP BY item_category", args={"y": year, "m": month}, fact=final_fact(spark, sf))


@register("case_label", sql(
    "SELECT user_id, clv_segment_label, CASE WHEN monthly_vip_status THEN 'VIP' ELSE 'Non-VIP' END AS vip, "
    "year, month, CASE WHEN month <= 3 THEN 'Winter' WHEN month <= 6 THEN 'Spring' WHEN month <= 9 "
    "THEN 'Summer' ELSE 'Fall' END AS season FROM (SELECT DISTINCT user_id, clv_segment_label, "
    "monthly_vip_status, year, month FROM v_fact)"))
def q_case_label(spark, sf):
    f = final_fact(spark, sf).select("user_id", "clv_segment_label", "monthly_vip_status", "year",
                                     "month").distinct()
    return f.select("user_id", "clv_segment_label",
                    F.when(F.col("monthly_vip_status"), "VIP").otherwise("Non-VIP").alias("vip"),
                    "year", "month", season("month").alias("season"))
