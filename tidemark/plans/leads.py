"""Lead -> owner enrichment (batch form; the stream form is in tidemark.streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import latest_within
from tidemark.plans.registry import register
from tidemark.plans.views import table

WAIT = "12 hours"
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def wait_seconds(wait: str) -> int:
    """Seconds of a text like ``10 minutes``."""
    number, unit = wait.split()
    return int(number) * UNIT_SECONDS[unit.rstrip("s")]


def v_leads(spark, sf):
    e = table(spark, sf, "events").filter(F.col("event_type") == "signup")
    return e.select(F.col("event_id").alias("lead_id"), "user_id",
                    F.concat(F.lit("Lead "), F.col("user_id").cast("string")).alias("display_name"),
                    F.col("ts").alias("date_created"), F.lit("Potential").alias("status_label"))


def v_owners(spark, sf):
    e = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return e.select(F.col("event_id").alias("owner_event_id"), F.col("user_id").alias("owner_user_id"),
                    F.col("ts").alias("owner_ts"),
                    F.concat(F.lit("lead"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("lead_email"),
                    F.concat(F.lit("owner"), (F.col("user_id") % 7).cast("string")).alias("lead_owner"),
                    F.when(F.col("value") > 100, "enterprise").otherwise("self-serve").alias("funnel"))


def enrich_leads(leads: DataFrame, owners: DataFrame, wait: str = WAIT) -> DataFrame:
    """Each lead with the latest owner record that arrived within ``wait``.

    One row per lead (:func:`latest_within`); leads without an owner record in the
    window keep NULL owner fields. Builds the notification text.
    """
    j = latest_within(leads, owners, [("user_id", "owner_user_id")], "date_created", "owner_ts",
                      wait_seconds(wait), ["owner_event_id"])
    msg = F.concat_ws(" | ", F.concat(F.lit("New lead: "), F.col("display_name")),
                      F.concat(F.lit("id "), F.col("lead_id").cast("string")),
                      F.concat(F.lit("status "), F.col("status_label")),
                      F.concat(F.lit("owner "), F.coalesce(F.col("lead_owner"), F.lit("unassigned"))),
                      F.concat(F.lit("funnel "), F.coalesce(F.col("funnel"), F.lit("unknown"))))
    return j.select("lead_id", "display_name", "date_created", "status_label", "lead_email", "lead_owner",
                    "funnel", msg.alias("message"))


ORACLE = """WITH l AS (SELECT event_id AS lead_id, user_id, 'Lead ' || CAST(user_id AS VARCHAR) AS display_name,
  ts AS date_created, 'Potential' AS status_label FROM events WHERE event_type = 'signup'),
o AS (SELECT event_id AS owner_event_id, user_id AS owner_user_id, ts AS owner_ts,
  'lead' || CAST(user_id AS VARCHAR) || '@example.com' AS lead_email, 'owner' || CAST(user_id % 7 AS VARCHAR) AS lead_owner,
  CASE WHEN value > 100 THEN 'enterprise' ELSE 'self-serve' END AS funnel FROM events WHERE event_type = 'purchase'),
j AS (SELECT * FROM l LEFT JOIN o ON l.user_id = o.owner_user_id AND o.owner_ts >= l.date_created
  AND o.owner_ts <= l.date_created + INTERVAL 12 HOUR
  QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY owner_ts DESC NULLS LAST, owner_event_id DESC NULLS LAST) = 1)
SELECT lead_id, display_name, date_created, status_label, lead_email, lead_owner, funnel,
  'New lead: ' || display_name || ' | id ' || CAST(lead_id AS VARCHAR) || ' | status ' || status_label ||
  ' | owner ' || COALESCE(lead_owner, 'unassigned') || ' | funnel ' || COALESCE(funnel, 'unknown') AS message FROM j"""


@register("lead_owner_enrich", ORACLE)
def q_enrich(spark, sf):
    return enrich_leads(v_leads(spark, sf), v_owners(spark, sf))
