"""Semi-structured event operators: JSON parsing, flattening, envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, DoubleType, StringType, StructField,
                               StructType)

from tidemark.functions.columns import uri_segment

S = StringType()
# Fixed schema of the booking webhook event (explicit: no inference scan).
MEMBER = StructType([StructField("user_name", S), StructField("user_email", S)])
EVENT_SCHEMA = StructType([
    StructField("event", S),
    StructField("payload", StructType([
        StructField("uri", S), StructField("status", S), StructField("name", S), StructField("email", S),
        StructField("scheduling_method", S), StructField("timezone", S),
        StructField("scheduled_event", StructType([
            StructField("event_type", S), StructField("created_at", S), StructField("start_time", S),
            StructField("end_time", S), StructField("name", S),
            StructField("event_memberships", ArrayType(MEMBER)),
            StructField("location", StructType([StructField("type", S)])),
        ])),
        StructField("tracking", StructType([StructField("utm_campaign", S), StructField("utm_source", S),
                                            StructField("utm_medium", S)])),
    ])),
])


def _utc_time(text: Column) -> Column:
    """UTC wall time of a timestamp text; an offset counts, bad text is NULL (the session runs in UTC)."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def flatten_event(df: DataFrame) -> DataFrame:
    """Nested booking event -> the 19 flat silver columns (+ ingested_at)."""
    p = "payload"
    se = f"{p}.scheduled_event"
    return df.select(
        uri_segment(F.col(f"{p}.uri"), 6).alias("invitee_id"),
        F.col("event").alias("webhook_event"),
        F.col(f"{p}.status").alias("invitee_status"),
        F.col(f"{p}.name").alias("invitee_name"),
        F.col(f"{p}.email").alias("invitee_email"),
        F.col(f"{p}.scheduling_method").alias("scheduling_method"),
        F.col(f"{p}.timezone").alias("timezone"),
        F.col(f"{se}.event_type").alias("event_type"),
        _utc_time(F.col(f"{se}.created_at")).alias("event_create_time"),
        _utc_time(F.col(f"{se}.start_time")).alias("event_start_time"),
        _utc_time(F.col(f"{se}.end_time")).alias("event_end_time"),
        F.col(f"{se}.name").alias("event_name"),
        F.array_join(F.transform(F.col(f"{se}.event_memberships"), lambda m: m["user_name"]), ", ")
        .alias("host_user_names"),
        F.array_join(F.transform(F.col(f"{se}.event_memberships"), lambda m: m["user_email"]), ", ")
        .alias("host_user_emails"),
        F.col(f"{se}.location.type").alias("location_type"),
        F.col(f"{p}.tracking.utm_campaign").alias("utm_campaign"),
        F.col(f"{p}.tracking.utm_source").alias("utm_source"),
        F.col(f"{p}.tracking.utm_medium").alias("utm_medium"),
        F.col("ingested_at"),
    )


def parse_json_column(df: DataFrame, col: str, schema: StructType, corrupt: str = "_corrupt_record") -> DataFrame:
    """Strict-schema parse of a JSON text column; unparsable text lands in ``corrupt``."""
    full = StructType(schema.fields + [StructField(corrupt, S)])
    parsed = F.from_json(F.col(col), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    return df.withColumn("_parsed", parsed).select("*", "_parsed.*").drop("_parsed")


def split_corrupt(df: DataFrame, corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) of a permissively parsed frame."""
    return df.filter(F.col(corrupt).isNull()).drop(corrupt), df.filter(F.col(corrupt).isNotNull())


def unwrap_envelope(raw: Column) -> tuple[Column, Column, Column]:
    """Returns (payload_json, lead_id, is_valid).

    A payload with a *string* ``body`` is the wrapped form: the body text is the
    real payload. ``event`` missing -> lead id ``unknown_lead``; a lead id missing
    inside ``event`` stays NULL. Invalid JSON gives is_valid = false.
    """
    body = F.try_variant_get(F.try_parse_json(raw), "$.body", "variant")
    # Wherever the key stands: only a non-empty text body wraps another payload.
    wrapped = F.coalesce((F.schema_of_variant(body) == "STRING") & (F.get_json_object(raw, "$.body") != ""), F.lit(False))
    payload = F.when(wrapped, F.get_json_object(raw, "$.body")).otherwise(raw)
    valid = F.try_parse_json(raw).isNotNull() & F.try_parse_json(payload).isNotNull()
    event = F.get_json_object(payload, "$.event")
    lead = F.when(event.isNull(), F.lit("unknown_lead")).otherwise(F.get_json_object(payload, "$.event.lead_id"))
    return payload, F.when(valid, lead), valid


VISITOR_SCHEMA = StructType([
    StructField("visitor_key", S), StructField("created_at", S), StructField("last_active_at", S),
    StructField("last_event_key", S), StructField("load_count", IntegerType()),
    StructField("play_count", IntegerType()),
    StructField("visitor_identity", StructType([
        StructField("name", S), StructField("email", S),
        StructField("org", StructType([StructField("name", S), StructField("title", S)]))])),
    StructField("user_agent_details", StructType([
        StructField("browser", S), StructField("browser_version", S), StructField("platform", S),
        StructField("mobile", S)])),
])

ACTION = StructType([StructField("type", S), StructField("action_count", IntegerType()),
                     StructField("impression_count", IntegerType()), StructField("rate", DoubleType()),
                     StructField("url", S), StructField("text", S)])
MEDIA_SCHEMA = StructType([
    StructField("media_id", S), StructField("load_count", IntegerType()), StructField("play_count", IntegerType()),
    StructField("play_rate", DoubleType()), StructField("hours_watched", DoubleType()),
    StructField("engagement", DoubleType()), StructField("visitors", IntegerType()),
    StructField("actions", ArrayType(ACTION)),
])


def visitor_flat(df: DataFrame, col: str = "raw") -> DataFrame:
    v = F.from_json(F.col(col), VISITOR_SCHEMA).alias("v")
    return df.select(v).select(
        "v.visitor_key", _utc_time(F.col("v.created_at")).alias("created_at"),
        _utc_time(F.col("v.last_active_at")).alias("last_active_at"), "v.last_event_key", "v.load_count",
        "v.play_count", F.col("v.visitor_identity.name").alias("visitor_name"),
        F.col("v.visitor_identity.email").alias("visitor_email"),
        F.col("v.visitor_identity.org.name").alias("org_name"),
        F.col("v.visitor_identity.org.title").alias("org_title"),
        F.col("v.user_agent_details.browser").alias("browser"),
        F.col("v.user_agent_details.browser_version").alias("browser_version"),
        F.col("v.user_agent_details.platform").alias("platform"),
        (F.lower(F.col("v.user_agent_details.mobile")) == "true").alias("mobile"))


def browser_filter(visitors: DataFrame, browsers=("Facebook", "YouTube")) -> DataFrame:
    """Visitors from the given browsers, with has_name / has_email flags."""
    has = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
    return (visitors.filter(F.col("browser").isin(list(browsers)))
            .withColumns({"has_name": has("visitor_name"), "has_email": has("visitor_email")}))


def media_stats_flat(df: DataFrame, col: str = "raw") -> DataFrame:
    """Media stats record -> one row per action (one row with NULL action when none)."""
    m = df.select(F.from_json(F.col(col), MEDIA_SCHEMA).alias("m"))
    return m.select("m.media_id", "m.load_count", "m.play_count", "m.play_rate", "m.hours_watched",
                    "m.engagement", "m.visitors", F.explode_outer("m.actions").alias("a")).select(
        "*", F.col("a.type").alias("action_type"), F.col("a.action_count").alias("action_count"),
        F.col("a.impression_count").alias("impression_count"), F.col("a.rate").alias("action_rate"),
        F.col("a.url").alias("action_url"), F.col("a.text").alias("action_text")).drop("a")
