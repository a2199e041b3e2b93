"""Keys for the cleaning / semi-structured operators over event-derived inputs.

Raw texts (webhook JSON, lead envelopes, visitor and media records, text
dates) are derived from the given tables with Spark expressions; the oracles
state the expected parse result directly from the source columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import table_name_from_file, uri_segment
from tidemark.operators import clean as C
from tidemark.operators import events as EV
from tidemark.operators.ranking import latest_per_key
from tidemark.plans.oracle_views import V_ITEMS
from tidemark.plans.registry import register
from tidemark.plans.views import table, v_items


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def raw_events(spark, sf):
    """Webhook JSON text per event, plus its arrival time."""
    e = table(spark, sf, "events")
    u, i, t = F.col("user_id"), F.col("event_id"), F.col("ts")
    host = lambda n: F.struct(
        F.concat(F.lit("host"), n.cast("string")).alias("user_name"),
        F.concat(F.lit("host"), n.cast("string"), F.lit("@example.com")).alias("user_email"))
    start = t + F.expr("INTERVAL 1 DAY")
    payload = F.struct(
        F.concat(F.lit("https://api.example.com/scheduled_events/EV"), i.cast("string"), F.lit("/invitees/inv"),
                 u.cast("string"), F.lit("-"), F.col("event_type")).alias("uri"),
        F.when(F.col("value") > 250, "canceled").otherwise("active").alias("status"),
        F.concat(F.lit("User "), u.cast("string")).alias("name"),
        F.concat(F.lit("user"), u.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(i % 2 == 0, F.lit("instant")).alias("scheduling_method"),
        F.lit("UTC").alias("timezone"),
        F.struct(F.col("event_type").alias("event_type"), _ts_text(t).alias("created_at"),
                 _ts_text(start).alias("start_time"),
                 _ts_text(start + F.expr("INTERVAL 30 MINUTES")).alias("end_time"),
                 F.concat(F.lit("Meeting "), F.col("event_type")).alias("name"),
                 F.array(host(u % 10), host((u + 3) % 10)).alias("event_memberships"),
                 F.struct(F.when(i % 5 != 0, F.when(u % 2 == 0, "zoom").otherwise("google_meet"))
                          .alias("type")).alias("location")).alias("scheduled_event"),
        F.struct(F.when(i % 4 != 0, F.concat(F.lit("camp"), (u % 5).cast("string"))).alias("utm_campaign"),
                 F.col("event_type").alias("utm_source"),
                 F.when(i % 3 != 0, F.lit("cpc")).alias("utm_medium")).alias("tracking"))
    return e.select(F.to_json(F.struct(F.lit("invitee.created").alias("event"), payload.alias("payload")))
                    .alias("raw"), (t + F.expr("INTERVAL 5 MINUTES")).alias("ingested_at"))


def parsed_events(spark, sf):
    r = raw_events(spark, sf)
    return r.select(F.from_json("raw", EV.EVENT_SCHEMA).alias("j"), "ingested_at").select("j.*", "ingested_at")


def silver_rows(spark, sf):
    return EV.flatten_event(parsed_events(spark, sf))


FLAT_SQL = """SELECT 'inv' || CAST(user_id AS VARCHAR) || '-' || event_type AS invitee_id,
  'invitee.created' AS webhook_event, CASE WHEN value > 250 THEN 'canceled' ELSE 'active' END AS invitee_status,
  'User ' || CAST(user_id AS VARCHAR) AS invitee_name, 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS invitee_email,
  CASE WHEN event_id % 2 = 0 THEN 'instant' END AS scheduling_method, 'UTC' AS timezone, event_type,
  ts AS event_create_time, ts + INTERVAL 1 DAY AS event_start_time,
  ts + INTERVAL 1 DAY + INTERVAL 30 MINUTE AS event_end_time, 'Meeting ' || event_type AS event_name,
  'host' || CAST(user_id % 10 AS VARCHAR) || ', host' || CAST((user_id + 3) % 10 AS VARCHAR) AS host_user_names,
  'host' || CAST(user_id % 10 AS VARCHAR) || '@example.com, host' || CAST((user_id + 3) % 10 AS VARCHAR) || '@example.com'
    AS host_user_emails,
  CASE WHEN event_id % 5 <> 0 THEN CASE WHEN user_id % 2 = 0 THEN 'zoom' ELSE 'google_meet' END END AS location_type,
  CASE WHEN event_id % 4 <> 0 THEN 'camp' || CAST(user_id % 5 AS VARCHAR) END AS utm_campaign,
  event_type AS utm_source, CASE WHEN event_id % 3 <> 0 THEN 'cpc' END AS utm_medium,
  ts + INTERVAL 5 MINUTE AS ingested_at FROM events"""

register("flatten_event", FLAT_SQL)(silver_rows)
register("array_names_join", "WITH " + V_ITEMS + """
SELECT order_id, string_agg(item_name, ', ' ORDER BY lineitem_id, item_name) AS item_names FROM v_items GROUP BY order_id""")(
    lambda s, sf: v_items(s, sf).groupBy("order_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lineitem_id", "item_name"))),
                                 lambda x: x["item_name"]), ", ").alias("item_names")))

LATEST_SQL = (f"SELECT * FROM ({FLAT_SQL}) QUALIFY row_number() OVER (PARTITION BY invitee_id "
              "ORDER BY ingested_at DESC, event_start_time DESC) = 1")
register("latest_per_key", LATEST_SQL)(
    lambda s, sf: latest_per_key(silver_rows(s, sf), ["invitee_id"], "ingested_at", ["event_start_time"]))

register("completeness_counts", f"""SELECT COUNT(1) AS total_rows, COUNT(location_type) AS populated_location_type,
  COUNT(utm_source) AS populated_utm_source, COUNT(utm_campaign) AS populated_utm_campaign,
  COUNT(utm_medium) AS populated_utm_medium FROM ({FLAT_SQL})""")(
    lambda s, sf: C.completeness(silver_rows(s, sf), ["location_type", "utm_source", "utm_campaign", "utm_medium"]))

register("uri_segment", """SELECT page_id, url, split(url, '/')[4] AS seg3, split(url, '/')[7] AS seg6 FROM pages""")(
    lambda s, sf: table(s, sf, "pages").select("page_id", "url", uri_segment("url", 3).alias("seg3"),
                                               uri_segment("url", 6).alias("seg6")))


def _route_sql(expr):
    stem = f"regexp_replace({expr}, '^(.*[^.].*)\\.[^.]*$', '\\1')"
    clean = f"lower(regexp_replace({stem}, '[^a-zA-Z0-9_]', '_', 'g'))"
    return f"CASE WHEN regexp_matches({clean}, '^[0-9]') THEN 'table_' || {clean} ELSE {clean} END"


register("file_to_table_route", f"""SELECT page_id,
  {_route_sql("regexp_extract(url, '([^/]*)$', 1)")} AS route_from_path,
  {_route_sql("split(url, '/')[3]")} AS route_from_host FROM pages""")(
    lambda s, sf: table(s, sf, "pages").select(
        "page_id", table_name_from_file("url").alias("route_from_path"),
        table_name_from_file(F.get(F.split("url", "/"), 2)).alias("route_from_host")))


def lead_envelopes(spark, sf):
    e = table(spark, sf, "events")
    i = F.col("event_id")
    s = i.cast("string")
    raw = (F.when(i % 4 == 0, F.concat(F.lit('{"body": "{\\"event\\": {\\"lead_id\\": '), s, F.lit('}}"}')))
           .when(i % 4 == 1, F.concat(F.lit('{"event": {"lead_id": '), s, F.lit("}}")))
           .when(i % 4 == 2, F.concat(F.lit('{"other": '), s, F.lit("}")))
           .when(i % 8 == 3, F.concat(F.lit('{"event": {"name": "n'), s, F.lit('"}}')))
           .otherwise(F.concat(F.lit('{"event": '), s)))
    return e.select("event_id", raw.alias("raw"))


def q_unwrap(spark, sf):
    d = lead_envelopes(spark, sf)
    _, lead, valid = EV.unwrap_envelope(F.col("raw"))
    return d.select("event_id", lead.alias("lead_id"), valid.alias("is_valid"))


register("unwrap_envelope", """SELECT event_id,
  CASE WHEN event_id % 4 IN (0, 1) THEN CAST(event_id AS VARCHAR) WHEN event_id % 4 = 2 THEN 'unknown_lead' END AS lead_id,
  NOT (event_id % 8 = 7) AS is_valid FROM events""")(q_unwrap)


def q_corrupt(spark, sf):
    e = table(spark, sf, "events")
    text = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit('{"k": '), F.col("event_id").cast("string"))) \
        .otherwise(F.col("props"))
    from pyspark.sql.types import IntegerType, StructField, StructType
    p = EV.parse_json_column(e.select("event_id", text.alias("props_text")), "props_text",
                             StructType([StructField("k", IntegerType())]))
    return p.select("event_id", "k", F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


register("json_corrupt_split", """SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL
  ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k, event_id % 97 = 0 AS is_corrupt FROM events""")(q_corrupt)


def visitors_raw(spark, sf):
    e = table(spark, sf, "events")
    u, i = F.col("user_id"), F.col("event_id")
    browser = F.element_at(F.array(*[F.lit(b) for b in ("Facebook", "YouTube", "Chrome", "Safari")]),
                           (i % 4 + 1).cast("int"))
    rec = F.struct(
        F.concat(F.lit("v"), i.cast("string")).alias("visitor_key"), _ts_text(F.col("ts")).alias("created_at"),
        _ts_text(F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("last_active_at"),
        F.concat(F.lit("e"), i.cast("string")).alias("last_event_key"), (i % 9).cast("int").alias("load_count"),
        (i % 4).cast("int").alias("play_count"),
        F.struct(F.when(i % 3 != 0, F.concat(F.lit("Name "), u.cast("string"))).alias("name"),
                 F.when(i % 5 != 0, F.concat(F.lit("v"), u.cast("string"), F.lit("@example.com"))).alias("email"),
                 F.struct(F.concat(F.lit("Org "), (u % 13).cast("string")).alias("name"),
                          F.lit("Analyst").alias("title")).alias("org")).alias("visitor_identity"),
        F.struct(browser.alias("browser"), (i % 30 + 90).cast("string").alias("browser_version"),
                 F.when(u % 2 == 0, "Windows").otherwise("Mac").alias("platform"),
                 F.when(i % 6 == 0, "true").otherwise("false").alias("mobile")).alias("user_agent_details"))
    return e.select(F.to_json(rec).alias("raw"))


VISITOR_SQL = """SELECT 'v' || CAST(event_id AS VARCHAR) AS visitor_key, ts AS created_at, ts + INTERVAL 2 HOUR AS last_active_at,
  'e' || CAST(event_id AS VARCHAR) AS last_event_key, CAST(event_id % 9 AS INTEGER) AS load_count,
  CAST(event_id % 4 AS INTEGER) AS play_count,
  CASE WHEN event_id % 3 <> 0 THEN 'Name ' || CAST(user_id AS VARCHAR) END AS visitor_name,
  CASE WHEN event_id % 5 <> 0 THEN 'v' || CAST(user_id AS VARCHAR) || '@example.com' END AS visitor_email,
  'Org ' || CAST(user_id % 13 AS VARCHAR) AS org_name, 'Analyst' AS org_title,
  ['Facebook', 'YouTube', 'Chrome', 'Safari'][event_id % 4 + 1] AS browser,
  CAST(event_id % 30 + 90 AS VARCHAR) AS browser_version,
  CASE WHEN user_id % 2 = 0 THEN 'Windows' ELSE 'Mac' END AS platform, event_id % 6 = 0 AS mobile FROM events"""
register("visitor_flat", VISITOR_SQL)(lambda s, sf: EV.visitor_flat(visitors_raw(s, sf)))
register("browser_filter", f"""SELECT *, visitor_name IS NOT NULL AND trim(visitor_name) <> '' AS has_name,
  visitor_email IS NOT NULL AND trim(visitor_email) <> '' AS has_email FROM ({VISITOR_SQL})
  WHERE browser IN ('Facebook', 'YouTube')""")(lambda s, sf: EV.browser_filter(EV.visitor_flat(visitors_raw(s, sf))))


def media_raw(spark, sf):
    e = table(spark, sf, "events")
    i = F.col("event_id")
    n = (i % 3).cast("int")
    acts = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.struct(
        F.concat(F.lit("cta"), k.cast("string")).alias("type"), (i % 7 + k).cast("int").alias("action_count"),
        (i % 11 + k * 2).cast("int").alias("impression_count"),
        ((i % 7 + k).cast("double") / (i % 11 + k * 2).cast("double")).alias("rate"),
        F.concat(F.lit("https://example.com/a"), k.cast("string")).alias("url"),
        F.concat(F.lit("Action "), k.cast("string")).alias("text")))
    acts = F.when(n == 0, F.array().cast("array<struct<type:string,action_count:int,impression_count:int,"
                                        "rate:double,url:string,text:string>>")).otherwise(acts)
    rec = F.struct(F.concat(F.lit("m"), i.cast("string")).alias("media_id"), (i % 50).cast("int").alias("load_count"),
                   (i % 20).cast("int").alias("play_count"),
                   ((i % 20).cast("double") / 50).alias("play_rate"), (F.col("value") / 4).alias("hours_watched"),
                   ((i % 100).cast("double") / 100).alias("engagement"), (i % 30).cast("int").alias("visitors"),
                   acts.alias("actions"))
    return e.select(F.to_json(rec).alias("raw"))


register("media_stats_flat", """SELECT 'm' || CAST(event_id AS VARCHAR) AS media_id, CAST(event_id % 50 AS INTEGER) AS load_count,
  CAST(event_id % 20 AS INTEGER) AS play_count, CAST(event_id % 20 AS DOUBLE) / 50 AS play_rate, value / 4 AS hours_watched,
  CAST(event_id % 100 AS DOUBLE) / 100 AS engagement, CAST(event_id % 30 AS INTEGER) AS visitors,
  CASE WHEN k IS NULL THEN NULL ELSE 'cta' || CAST(k AS VARCHAR) END AS action_type,
  CAST(event_id % 7 + k AS INTEGER) AS action_count, CAST(event_id % 11 + k * 2 AS INTEGER) AS impression_count,
  CAST(event_id % 7 + k AS DOUBLE) / CAST(event_id % 11 + k * 2 AS DOUBLE) AS action_rate,
  CASE WHEN k IS NULL THEN NULL ELSE 'https://example.com/a' || CAST(k AS VARCHAR) END AS action_url,
  CASE WHEN k IS NULL THEN NULL ELSE 'Action ' || CAST(k AS VARCHAR) END AS action_text
  FROM events LEFT JOIN LATERAL (SELECT unnest(range(1, CAST(event_id % 3 AS BIGINT) + 1)) AS k) t ON TRUE""")(
    lambda s, sf: EV.media_stats_flat(media_raw(s, sf)))


# ---------------------------------------------------------------- simple column cleaning
def customers_dirty(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(
        "c_custkey",
        F.when(k % 5 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" \t"))).otherwise(F.col("c_name"))
        .alias("c_name"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_acctbal")


register("drop_null_if_present", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 13 <> 0")(
    lambda s, sf: C.trim_all_strings(C.drop_null_if_present(customers_dirty(s, sf), ["c_mktsegment", "PROVNUM"])))
register("trim_all_strings", """SELECT c_custkey, c_name, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END
  AS c_mktsegment, c_acctbal FROM customer""")(lambda s, sf: C.trim_all_strings(customers_dirty(s, sf)))


def orders_text_dates(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    start = (F.when(k % 90 == 0, F.lit(None).cast("string")).when(k % 70 == 0, F.lit("bad"))
             .when(k % 50 == 0, F.lit("02/30/1999"))
             .otherwise(F.date_format(F.date_add(d, 1), "MM/dd/yyyy")))
    return o.select("o_orderkey", F.date_format(d, "yyyyMMdd").alias("WorkDate"), start.alias("Start Date"))


register("date_parts_coerce", """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS "WorkDate",
  CASE WHEN o_orderkey % 90 = 0 THEN NULL WHEN o_orderkey % 70 = 0 THEN 'bad' WHEN o_orderkey % 50 = 0 THEN '02/30/1999'
       ELSE strftime(CAST(o_orderdate AS DATE) + 1, '%m/%d/%Y') END AS "Start Date",
  CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 70 = 0 OR o_orderkey % 90 = 0 THEN NULL
       ELSE CAST(year(CAST(o_orderdate AS DATE) + 1) AS INTEGER) END AS year,
  CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 70 = 0 OR o_orderkey % 90 = 0 THEN NULL
       ELSE CAST(month(CAST(o_orderdate AS DATE) + 1) AS INTEGER) END AS month,
  CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 70 = 0 OR o_orderkey % 90 = 0 THEN NULL
       ELSE CAST(day(CAST(o_orderdate AS DATE) + 1) AS INTEGER) END AS day FROM orders""")(
    lambda s, sf: C.date_parts(orders_text_dates(s, sf)))

register("bool_text_load", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE END
  AS is_loyalty FROM orders""")(
    lambda s, sf: C.text_to_bool(table(s, sf, "orders").select(
        "o_orderkey", F.element_at(F.array(*[F.lit(v) for v in ("TRUE", "FALSE", "true", "maybe", "")]),
                                   (F.col("o_orderkey") % 5 + 1).cast("int")).alias("is_loyalty")), ["is_loyalty"]))
