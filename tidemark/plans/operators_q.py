"""Keys that apply one cleaning, join or aggregation operator to a whole table, each with its own input and output."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import exact_sum, mean_of
from tidemark.operators.clean import (calendar_backfill, cast_if_needed, drop_all_null, drop_blank_keys,
                                      exclude_values, fill_zero)
from tidemark.operators.ranking import rows_of_top_groups, top_k
from tidemark.plans.bookings import DAILY, VB, VM, VSP, W, daily_bookings
from tidemark.plans.healthcare import HRS_BY_PROV, VS
from tidemark.plans.oracle_views import V_CAL, V_ITEMS, V_OPTS, with_views
from tidemark.plans.registry import register
from tidemark.plans.restaurant import ITEM_KEYS, attach_scalar, line_revenue
from tidemark.plans.restaurant_reports import REV_SQL, base_fact, sql
from tidemark.plans.retail import D as DEPTS, FA as FACTS, MARKDOWNS, pandas_sum
from tidemark.plans.views import (EXCLUDED_PROVIDERS, table, v_book, v_cal, v_depts, v_facts, v_items, v_mapping, v_opts, v_spend,
                                  v_staff)


@register("drop_blank_keys", with_views([V_ITEMS], """
    SELECT order_id, lineitem_id, user_id, restaurant_id FROM v_items
    WHERE trim(order_id) <> '' AND trim(lineitem_id) <> '' AND trim(user_id) <> '' AND trim(restaurant_id) <> ''
      AND creation_time_utc IS NOT NULL"""))
def q_drop_blank_keys(spark, sf):
    return drop_blank_keys(v_items(spark, sf), ITEM_KEYS, not_null=["creation_time_utc"]).select(
        "order_id", "lineitem_id", "user_id", "restaurant_id")


@register("left_join_multikey", with_views([V_ITEMS, V_OPTS], """
    SELECT i.order_id, i.lineitem_id, i.user_id, i.item_name, CAST(o.option_price AS DOUBLE) AS option_price, o.option_quantity
    FROM v_items i LEFT JOIN v_opts o ON i.order_id = o.order_id AND i.lineitem_id = o.lineitem_id"""))
def q_left_join_multikey(spark, sf):
    return v_items(spark, sf).join(v_opts(spark, sf), ["order_id", "lineitem_id"], "left").select(
        "order_id", "lineitem_id", "user_id", "item_name", F.col("option_price").cast("double").alias("option_price"),
        "option_quantity")


def _dated_orders(spark, sf):
    """Orders with the calendar's attributes, NULL for days that the calendar lacks."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.to_date("o_orderdate").alias("date_key"))
    cal = v_cal(spark, sf).withColumn("date_key", F.to_date("date_key", "dd-MM-yyyy"))
    return orders.join(cal, "date_key", "left")


@register("left_join_calendar", with_views([V_CAL], """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date_key, year, week, day_of_week, holiday_name
    FROM orders LEFT JOIN v_cal ON CAST(o_orderdate AS DATE) = cal_date"""))
def q_left_join_calendar(spark, sf):
    return _dated_orders(spark, sf).select("o_orderkey", "date_key", "year", "week", "day_of_week", "holiday_name")


@register("calendar_backfill", with_views([V_ITEMS], """
    SELECT order_id, lineitem_id, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
           CAST(week(t) AS INTEGER) AS week, dayname(t) AS day_of_week, dayofweek(t) IN (0, 6) AS is_weekend,
           year(t) = 1998 AND strftime(t, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday, CAST(day(t) AS INTEGER) AS day
    FROM (SELECT order_id, lineitem_id, creation_time_utc AS t FROM v_items)"""))
def q_calendar_backfill(spark, sf):
    """Items of all years against a calendar of one: what it lacks comes from the timestamp."""
    items = v_items(spark, sf).select("order_id", "lineitem_id", "creation_time_utc", F.to_date("creation_time_utc").alias("date_key"))
    cal = v_cal(spark, sf).withColumn("date_key", F.to_date("date_key", "dd-MM-yyyy"))
    return calendar_backfill(items.join(cal, "date_key", "left"), "creation_time_utc").select(
        "order_id", "lineitem_id", "year", "month", "week", "day_of_week", "is_weekend", "is_holiday", "day")


@register("date_key_parse", """
    SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS date_key FROM orders""")
def q_date_key_parse(spark, sf):
    text = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yyyy").alias("date_text"))
    return text.select("o_orderkey", F.to_date("date_text", "dd-MM-yyyy").alias("date_key"))


MARKS = ", ".join(MARKDOWNS)


@register("fill_zero", W(DEPTS, FACTS) + "SELECT store_id, date, " + ", ".join(f"COALESCE({m}, 0) AS {m}" for m in MARKDOWNS)
          + ", CASE WHEN markdown_1 IS NOT NULL THEN 'promo' END AS note FROM v_facts")
def q_fill_zero(spark, sf):
    """Missing markdowns become 0; the text column is listed too and stays as it is."""
    note = F.when(F.col("markdown_1").isNotNull(), "promo").alias("note")
    return fill_zero(v_facts(spark, sf).select("store_id", "date", *MARKDOWNS, note), [*MARKDOWNS, "note"])


@register("cast_if_needed", with_views([V_ITEMS], """
    SELECT order_id, lineitem_id, CASE WHEN CAST(order_id AS BIGINT) % 11 <> 0 THEN creation_time_utc END AS placed,
           CASE WHEN CAST(order_id AS BIGINT) % 7 <> 0 THEN CAST(item_price AS DOUBLE) END AS price,
           creation_time_utc AS typed, CAST(item_quantity AS BIGINT) AS quantity
    FROM v_items"""))
def q_cast_if_needed(spark, sf):
    """Times and prices as text, bad text among them; a column that has its type already stays untouched."""
    key, time = F.col("order_id").cast("bigint"), F.col("creation_time_utc")
    text = v_items(spark, sf).select(
        "order_id", "lineitem_id", F.when(key % 11 == 0, F.lit("no date")).otherwise(F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("placed"),
        F.when(key % 7 == 0, F.lit("12,5 EUR")).otherwise(F.col("item_price").cast("string")).alias("price"),
        time.alias("typed"), F.col("item_quantity").alias("quantity"))
    return cast_if_needed(text, {"placed": "timestamp_ntz", "price": "double", "typed": "timestamp_ntz", "quantity": "bigint"})


@register("exclude_values", """
    SELECT event_id, provider_name, total_nurse_hrs FROM (SELECT event_id, value AS total_nurse_hrs,
        CASE WHEN event_id % 17 <> 0 THEN 'Provider ' || CAST(user_id AS VARCHAR) END AS provider_name FROM events)
    WHERE provider_name IS NULL OR provider_name NOT IN ('Provider 7', 'Provider 11')""")
def q_exclude_values(spark, sf):
    """Staffing rows without two providers; rows without a name stay."""
    rows = table(spark, sf, "events").select("event_id", F.when(
        F.col("event_id") % 17 != 0, F.concat(F.lit("Provider "), F.col("user_id").cast("string"))).alias("provider_name"),
        F.col("value").alias("total_nurse_hrs"))
    return exclude_values(rows, "provider_name", EXCLUDED_PROVIDERS)


@register("drop_all_null", W(DEPTS, FACTS) + f"SELECT store_id, date, {MARKS} FROM v_facts WHERE COALESCE({MARKS}) IS NOT NULL")
def q_drop_all_null(spark, sf):
    return drop_all_null(v_facts(spark, sf).select("store_id", "date", *MARKDOWNS), MARKDOWNS)


@register("sum_by_keys", W(DEPTS) + """
    SELECT store_id, is_holiday, COALESCE(CAST(SUM(weekly_sales) AS DOUBLE), 0) AS total_sales FROM v_depts
    WHERE store_id IS NOT NULL AND is_holiday IS NOT NULL GROUP BY store_id, is_holiday""")
def q_sum_by_keys(spark, sf):
    return pandas_sum(v_depts(spark, sf), ["store_id", "is_holiday"], "weekly_sales", "total_sales")


@register("multi_sum", W(DEPTS, FACTS) + "SELECT CAST(year(date) AS INTEGER) AS year, store_id, "
          + ", ".join(f"COALESCE(CAST(SUM({m}) AS DOUBLE), 0) AS {m}_total" for m in MARKDOWNS) + " FROM v_facts GROUP BY 1, 2")
def q_multi_sum(spark, sf):
    return v_facts(spark, sf).groupBy(F.year("date").alias("year"), "store_id").agg(
        *[F.coalesce(exact_sum(m), F.lit(0.0)).alias(f"{m}_total") for m in MARKDOWNS])


@register("mean_by_keys", W(DEPTS, FACTS) + """
    SELECT store_id, CAST(month(date) AS INTEGER) AS month, CAST(SUM(markdown_1) AS DOUBLE) / NULLIF(COUNT(markdown_1), 0) AS mean_markdown
    FROM v_facts GROUP BY 1, 2""")
def q_mean_by_keys(spark, sf):
    """Means that leave out missing markdowns; NULL where all are missing."""
    return v_facts(spark, sf).groupBy("store_id", F.month("date").alias("month")).agg(mean_of("markdown_1").alias("mean_markdown"))


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


@register("topk_rows", """
    SELECT o_orderkey, o_totalprice, CAST(row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS INTEGER) AS rank
    FROM orders QUALIFY rank <= 10""")
def q_topk_rows(spark, sf):
    return top_k(_orders(spark, sf).select("o_orderkey", "o_totalprice"), "o_totalprice", 10, tiebreak=["o_orderkey"])


@register("semi_filter_topk", W(VS) + f"""SELECT provider_name, month, day, total_nurse_hrs FROM v_staff WHERE provider_name IN
        (SELECT provider_name FROM ({HRS_BY_PROV}) ORDER BY total_nurse_hrs DESC NULLS LAST, provider_name LIMIT 10)""")
def q_semi_filter_topk(spark, sf):
    """Staffing rows of the ten providers with the most hours."""
    staff = v_staff(spark, sf)
    hours = staff.groupBy("provider_name").agg(exact_sum("total_nurse_hrs").alias("hours"))
    return rows_of_top_groups(staff, top_k(hours, "hours", 10, tiebreak=["provider_name"]), ["provider_name"]).select(
        "provider_name", "month", "day", "total_nurse_hrs")


@register("topk_groups", """
    SELECT o_orderpriority, o_custkey, n, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_custkey) AS INTEGER) AS rank
    FROM (SELECT o_orderpriority, o_custkey, COUNT(*) AS n FROM orders GROUP BY o_orderpriority, o_custkey) QUALIFY rank <= 3""")
def q_topk_groups(spark, sf):
    counts = _orders(spark, sf).groupBy("o_orderpriority", "o_custkey").agg(F.count("*").alias("n"))
    return top_k(counts, "n", 3, tiebreak=["o_custkey"], group=["o_orderpriority"])


@register("top1_group", sql(f"""
    SELECT year, month, item_category, CAST(revenue AS DOUBLE) AS revenue FROM
        (SELECT year, month, item_category, SUM{REV_SQL} AS revenue FROM v_fact_base GROUP BY year, month, item_category)
    QUALIFY row_number() OVER (PARTITION BY year, month ORDER BY revenue DESC, item_category) = 1"""))
def q_top1_group(spark, sf):
    """Best-selling category of every month."""
    sums = base_fact(spark, sf).groupBy("year", "month", "item_category").agg(exact_sum(line_revenue()).alias("revenue"))
    return top_k(sums, "revenue", 1, tiebreak=["item_category"], group=["year", "month"], rank_col=None)


@register("cross_join_scalar", with_views([V_ITEMS], """
    SELECT order_id, lineitem_id, CAST(item_price AS DOUBLE) AS item_price,
           (SELECT CAST(MAX(item_price) AS DOUBLE) FROM v_items) AS dearest, (SELECT COUNT(*) FROM v_items) AS items FROM v_items"""))
def q_cross_join_scalar(spark, sf):
    """Every item beside two figures of the whole table."""
    items = v_items(spark, sf).select("order_id", "lineitem_id", F.col("item_price").cast("double").alias("item_price"))
    return attach_scalar(items, items.agg(F.max("item_price").alias("dearest"), F.count("*").alias("items")))


@register("left_join_compound", W(VB, VM, VSP, DAILY) + """SELECT CAST(s.date AS DATE) AS spend_date, s.channel, s.spend,
    COALESCE(d.total_meetings_booked, 0) AS bookings
    FROM v_spend s LEFT JOIN v_daily d ON CAST(s.date AS DATE) = d.meeting_date AND s.channel = d.channel_name""")
def q_left_join_compound(spark, sf):
    """Spend per day and channel with its bookings by (day, channel); without any, NULL becomes 0."""
    booked = daily_bookings(v_book(spark, sf), v_mapping(spark))
    spend = v_spend(spark, sf).withColumn("spend_date", F.to_date("date", "yyyy-MM-dd"))
    both = spend.join(booked, (spend["spend_date"] == booked["meeting_date"]) & (spend["channel"] == booked["channel_name"]), "left")
    return fill_zero(both.withColumnRenamed("total_meetings_booked", "bookings"), ["bookings"]) \
        .select("spend_date", "channel", "spend", "bookings")
