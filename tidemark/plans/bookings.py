"""Booking (meeting) analytics: cost per booking and channel reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.registry import register
from tidemark.plans.views import v_book, v_mapping, v_spend


def daily_bookings(silver: DataFrame, mapping: DataFrame) -> DataFrame:
    """Bookings per (meeting date, mapped channel); unmapped event types dropped."""
    m = mapping
    j = silver.join(m, silver.event_type == m.event_type_uri, "inner")
    return (j.groupBy(F.to_date("event_start_time").alias("meeting_date"), "channel_name")
            .agg(F.count(F.lit(1)).alias("total_meetings_booked")))


def cost_per_booking(spend: DataFrame, silver: DataFrame, mapping: DataFrame) -> DataFrame:
    """Spend per day and channel with bookings (0 if none) and cost per booking.

    Days without bookings are kept (left join); their cost is the spend itself.
    """
    daily = daily_bookings(silver, mapping)
    s = (spend.withColumn("spend_date", F.to_date("date", "yyyy-MM-dd")).drop("date")
         .join(mapping.select("channel_name"),
               F.col("channel") == F.col("channel_name"), "inner").drop("channel_name"))
    j = s.join(daily, (s.spend_date == daily.meeting_date) & (s.channel == daily.channel_name), "left")
    n = F.col("total_meetings_booked")
    return j.select(
        "spend_date", F.col("channel").alias("marketing_channel"),
        F.col("spend").cast("double").alias("ad_spend"),
        F.coalesce(n, F.lit(0)).alias("meetings_booked"),
        F.when(n > 0, F.col("spend") / n).otherwise(F.col("spend")).cast("double").alias("cost_per_booking"))


def bookings_by_period(silver: DataFrame, unit: str) -> DataFrame:
    return (silver.groupBy(F.to_date(F.date_trunc(unit, "event_start_time")).alias("period_start"),
                           F.col("event_type").alias("source"))
            .agg(F.count(F.lit(1)).alias("bookings")))


def channel_leaderboard(spend: DataFrame, silver: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per channel: bookings, spend, cost per booking = sum(spend)/sum(bookings), ranked (cheapest first)."""
    c = cost_per_booking(spend, silver, mapping)
    g = c.groupBy("marketing_channel").agg(
        F.sum("meetings_booked").alias("bookings"),
        F.sum(F.col("ad_spend").cast("decimal(28,10)")).cast("double").alias("spend"))
    g = g.withColumn("cpb", F.try_divide(F.col("spend"), F.col("bookings").cast("double")))
    # One row per channel: the ranking window over it is bounded.
    return g.withColumn("cpb_rank", F.rank().over(Window.orderBy(F.col("cpb").asc_nulls_last())))


def booking_heatmap(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.hour("event_start_time").alias("hour"),
                          F.dayofweek("event_start_time").alias("day_of_week"),
                          F.col("event_type").alias("channel")).agg(F.count(F.lit(1)).alias("bookings"))


def hosts(silver: DataFrame) -> DataFrame:
    """Booking with its host list (names as a ', '-joined text, like the silver table)."""
    arr = F.array_distinct(F.array(F.concat(F.lit("host"), F.col("host_id").cast("string")),
                                   F.concat(F.lit("host"), ((F.col("user_id") + 3) % 10).cast("string"))))
    return silver.withColumn("host_user_names", F.array_join(arr, ", "))


def meeting_load(silver: DataFrame) -> DataFrame:
    """Per host: meetings, active weeks, meetings per week, busiest and quietest week."""
    e = hosts(silver).select(F.explode(F.split("host_user_names", ", ")).alias("host"),
                             F.to_date(F.date_trunc("week", "event_start_time")).alias("week"))
    wk = e.groupBy("host", "week").agg(F.count(F.lit(1)).alias("n"))
    return wk.groupBy("host").agg(
        F.sum("n").alias("meetings"), F.count(F.lit(1)).alias("weeks"),
        (F.sum("n").cast("double") / F.count(F.lit(1))).alias("meetings_per_week"),
        F.max("n").alias("max_week"), F.min("n").alias("min_week"))


def cumulative_bookings(silver: DataFrame) -> DataFrame:
    d = silver.groupBy(F.col("event_type").alias("source"), F.to_date("event_start_time").alias("date")) \
        .agg(F.count(F.lit(1)).alias("bookings"))
    w = Window.partitionBy("source").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("cumulative_bookings", F.sum("bookings").over(w))


# ------------------------------------------------------------------ oracle text
VB = """v_book AS (SELECT CAST(event_id AS VARCHAR) AS invitee_id, event_type, ts AS event_start_time,
  CAST(user_id % 10 AS INTEGER) AS host_id, user_id FROM events)"""
VM = """v_map AS (SELECT * FROM (VALUES ('facebook_paid_ads', 'click'), ('youtube_paid_ads', 'view'),
  ('tiktok_paid_ads', 'signup')) t(channel_name, event_type_uri))"""
VSP = """v_spend AS (SELECT strftime(d, '%Y-%m-%d') AS date, c.channel,
  CAST((dayofyear(d) * 31 + c.ch_idx * 7) % 500 AS DOUBLE) + CAST((dayofyear(d) * 31 + c.ch_idx * 7) % 4 AS DOUBLE) * 0.25 AS spend
  FROM (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE) - INTERVAL 2 DAY, CAST(max(ts) AS DATE) + INTERVAL 2 DAY,
        INTERVAL 1 DAY)) AS DATE) AS d FROM events) days
  CROSS JOIN (VALUES ('facebook_paid_ads', 0), ('youtube_paid_ads', 1), ('tiktok_paid_ads', 2), ('organic_search', 3))
    c(channel, ch_idx))"""
DAILY = ("v_daily AS (SELECT CAST(b.event_start_time AS DATE) AS meeting_date, m.channel_name, "
         "COUNT(*) AS total_meetings_booked FROM v_book b JOIN v_map m ON b.event_type = m.event_type_uri "
         "GROUP BY ALL)")
CPB = ("v_cpb AS (SELECT CAST(s.date AS DATE) AS spend_date, s.channel AS marketing_channel, "
       "CAST(s.spend AS DOUBLE) AS ad_spend, COALESCE(d.total_meetings_booked, 0) AS meetings_booked, "
       "CASE WHEN d.total_meetings_booked > 0 THEN s.spend / d.total_meetings_booked ELSE s.spend END "
       "AS cost_per_booking FROM v_spend s JOIN v_map m ON s.channel = m.channel_name "
       "LEFT JOIN v_daily d ON CAST(s.date AS DATE) = d.meeting_date AND s.channel = d.channel_name)")


def W(*p):
    return "WITH " + ", ".join(p) + "\n"


ORACLES = {
    "cost_per_booking": W(VB, VM, VSP, DAILY, CPB) + "SELECT * FROM v_cpb",
    "count_by_day_channel": W(VB, VM, DAILY) + "SELECT * FROM v_daily",
    "inner_join_mapping": W(VB, VM) + "SELECT b.*, m.channel_name, m.event_type_uri FROM v_book b "
    "JOIN v_map m ON b.event_type = m.event_type_uri",
    "bookings_daily_source": W(VB) + "SELECT CAST(date_trunc('day', event_start_time) AS DATE) AS period_start, "
    "event_type AS source, COUNT(*) AS bookings FROM v_book GROUP BY ALL",
    "bookings_weekly_source": W(VB) + "SELECT CAST(date_trunc('week', event_start_time) AS DATE) AS period_start, "
    "event_type AS source, COUNT(*) AS bookings FROM v_book GROUP BY ALL",
    "channel_leaderboard": W(VB, VM, VSP, DAILY, CPB) + "SELECT marketing_channel, CAST(SUM(meetings_booked) AS BIGINT) AS bookings, "
    "CAST(SUM(CAST(ad_spend AS DECIMAL(28,10))) AS DOUBLE) AS spend, "
    "CASE WHEN SUM(meetings_booked) = 0 THEN NULL ELSE CAST(SUM(CAST(ad_spend AS DECIMAL(28,10))) AS DOUBLE) / "
    "CAST(SUM(meetings_booked) AS DOUBLE) END AS cpb, "
    "CAST(rank() OVER (ORDER BY cpb ASC NULLS LAST) AS INTEGER) AS cpb_rank FROM v_cpb GROUP BY marketing_channel",
    "booking_heatmap": W(VB) + "SELECT CAST(hour(event_start_time) AS INTEGER) AS hour, "
    "CAST(dayofweek(event_start_time) + 1 AS INTEGER) AS day_of_week, event_type AS channel, COUNT(*) AS bookings "
    "FROM v_book GROUP BY ALL",
    "meeting_load": W(VB) + "SELECT host, CAST(SUM(n) AS BIGINT) AS meetings, COUNT(*) AS weeks, "
    "CAST(SUM(n) AS DOUBLE) / COUNT(*) AS meetings_per_week, MAX(n) AS max_week, MIN(n) AS min_week FROM ("
    "SELECT host, week, COUNT(*) AS n FROM (SELECT DISTINCT invitee_id, unnest(list_distinct_keep(["
    "'host' || CAST(host_id AS VARCHAR), 'host' || CAST((user_id + 3) % 10 AS VARCHAR)])) AS host, "
    "CAST(date_trunc('week', event_start_time) AS DATE) AS week, k FROM (SELECT *, 1 AS k FROM v_book)) "
    "GROUP BY host, week) GROUP BY host",
    "cumulative_bookings": W(VB) + "SELECT source, date, bookings, CAST(SUM(bookings) OVER (PARTITION BY source "
    "ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_bookings FROM ("
    "SELECT event_type AS source, CAST(event_start_time AS DATE) AS date, COUNT(*) AS bookings FROM v_book "
    "GROUP BY ALL)",
}
# Host pairs are distinct per booking: host_id != (user_id+3) % 10 always holds
# because host_id = user_id % 10, so the list never repeats an entry.
ORACLES["meeting_load"] = ORACLES["meeting_load"].replace("list_distinct_keep(", "(")

_Q = {
    "cost_per_booking": lambda s, sf: cost_per_booking(v_spend(s, sf), v_book(s, sf), v_mapping(s)),
    "count_by_day_channel": lambda s, sf: daily_bookings(v_book(s, sf), v_mapping(s)),
    "inner_join_mapping": lambda s, sf: v_book(s, sf).join(v_mapping(s),
                                                           F.col("event_type") == F.col("event_type_uri")),
    "bookings_daily_source": lambda s, sf: bookings_by_period(v_book(s, sf), "day"),
    "bookings_weekly_source": lambda s, sf: bookings_by_period(v_book(s, sf), "week"),
    "channel_leaderboard": lambda s, sf: channel_leaderboard(v_spend(s, sf), v_book(s, sf), v_mapping(s)),
    "booking_heatmap": lambda s, sf: booking_heatmap(v_book(s, sf)),
    "meeting_load": lambda s, sf: meeting_load(v_book(s, sf)),
    "cumulative_bookings": lambda s, sf: cumulative_bookings(v_book(s, sf)),
}
for _k, _f in _Q.items():
    register(_k, ORACLES[_k])(_f)
