"""Streaming keys: each runs its stream to completion on files derived from
the given tables and returns the resulting table (so the batch SQL is the
oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from tidemark.functions.columns import uri_segment
from tidemark.operators.events import EVENT_SCHEMA
from tidemark.plans.cleaning_q import FLAT_SQL, raw_events
from tidemark.plans.leads import ORACLE as LEADS_SQL, v_leads, v_owners
from tidemark.plans.registry import register
from tidemark.plans.upserts_q import _FLAT_COLS, SILVER_UPDATE, T0, T1, _split_key, dept_weeks, ts
from tidemark.plans.views import table
from tidemark.session import scratch_path
from tidemark.streaming import jobs


def _write_parts(df, path, fmt, parts, cond_of, **opts):
    """Write ``parts`` sets of files one after another (oldest first), one job each."""
    for i in range(parts):
        w = df.filter(cond_of(i)).write.mode("append").format(fmt)
        for k, v in opts.items():
            w = w.option(k, v)
        w.save(path)


def drained_events(spark, sf):
    """The bronze table of all events whose JSON lines arrive in two loads, every 97th event once more as a line cut short.

    The quarantine stream drains each load; a third drain finds nothing new.
    """
    src, dst, ck = (scratch_path(spark, n) for n in ("raw_json", "bronze", "ck_bronze"))
    raw = raw_events(spark, sf).select("raw", F.regexp_extract("raw", "/EV([0-9]+)/", 1).cast("long").alias("id"))
    cut = raw.where(F.col("id") % 97 == 0).select(F.expr("substring(raw, 1, length(raw) - 7)").alias("raw"), "id")
    for load in (0, 1):
        raw.unionByName(cut).where(F.col("id") % 2 == load).select("raw").write.mode("append").text(src)
        jobs.quarantine_stream(spark, src, EVENT_SCHEMA, dst, ck)
    jobs.quarantine_stream(spark, src, EVENT_SCHEMA, dst, ck)
    return dst


def q_bronze(spark, sf):
    b = jobs.read_quarantined(spark, drained_events(spark, sf), "good")
    return b.select(uri_segment("payload.uri", 6).alias("invitee_id"), F.col("event").alias("webhook_event"),
                    F.col("payload.status").alias("invitee_status"),
                    F.col("source_file").isNotNull().alias("has_source_file"),
                    F.col("ingested_at").isNotNull().alias("has_ingested_at"))


register("json_stream_bronze", f"""SELECT invitee_id, webhook_event, invitee_status, TRUE AS has_source_file,
  TRUE AS has_ingested_at FROM ({FLAT_SQL})""")(q_bronze)


def q_quarantine(spark, sf):
    """Every line that came in, by the sink it went to."""
    dst = drained_events(spark, sf)
    good, bad = (jobs.read_quarantined(spark, dst, k) for k in ("good", "bad"))
    event = lambda c: F.regexp_extract(c, "/EV([0-9]+)/", 1).cast("long").alias("event_id")
    return good.select(event(F.col("payload.uri")), F.lit(False).alias("quarantined")) \
        .unionByName(bad.select(event(F.col("_corrupt_record")), F.lit(True).alias("quarantined")))


register("json_stream_quarantine", """SELECT event_id, FALSE AS quarantined FROM events
  UNION ALL SELECT event_id, TRUE FROM events WHERE event_id % 97 = 0""")(q_quarantine)

LINEITEM_SCHEMA = StructType([
    StructField("l_orderkey", LongType()), StructField("l_partkey", LongType()), StructField("l_suppkey", LongType()),
    StructField("l_linenumber", IntegerType()), StructField("l_quantity", DoubleType()),
    StructField("l_extendedprice", DoubleType()), StructField("l_discount", DoubleType()),
    StructField("l_tax", DoubleType()), StructField("l_returnflag", StringType()),
    StructField("l_linestatus", StringType()), StructField("l_shipdate", TimestampNTZType())])


def q_csv_stream(spark, sf):
    src, dst, ck = (scratch_path(spark, n) for n in ("li_csv", "li_stream", "ck_li"))
    li = table(spark, sf, "lineitem")
    _write_parts(li, src, "csv", 3, lambda i: F.col("l_orderkey") % 3 == i, header="true",
                 timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    opts = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    jobs.ingest_stream(spark, src, LINEITEM_SCHEMA, dst, ck, fmt="csv", options=opts, add_metadata=False)
    jobs.ingest_stream(spark, src, LINEITEM_SCHEMA, dst, ck, fmt="csv", options=opts, add_metadata=False)
    return spark.read.parquet(dst)


register("csv_stream_append", "SELECT * FROM lineitem")(q_csv_stream)


def q_incremental(spark, sf):
    src, dst, ck = (scratch_path(spark, n) for n in ("ev_files", "ev_sink", "ck_ev"))
    e = table(spark, sf, "events")
    e.filter(F.col("event_id") % 2 == 0).write.parquet(src)
    jobs.ingest_stream(spark, src, e.schema, dst, ck, fmt="parquet", add_metadata=False)
    e.filter(F.col("event_id") % 2 == 1).write.mode("append").parquet(src)
    jobs.ingest_stream(spark, src, e.schema, dst, ck, fmt="parquet", add_metadata=False)
    jobs.ingest_stream(spark, src, e.schema, dst, ck, fmt="parquet", add_metadata=False)  # nothing new
    return spark.read.parquet(dst)


register("incremental_batch", "SELECT * FROM events")(q_incremental)

CUTS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00"]


def _third(c):
    return F.when(c < ts(CUTS[0]), 0).when(c < ts(CUTS[1]), 1).otherwise(2)


def q_upsert_stream(spark, sf):
    bronze, tdir, ck = (scratch_path(spark, n) for n in ("bronze_pq", "silver_tbl", "ck_silver"))
    raw = raw_events(spark, sf)
    b = raw.select(F.from_json("raw", EVENT_SCHEMA).alias("j"), "ingested_at").select("j.*", "ingested_at")
    b = b.withColumn("_part", _third(F.to_timestamp_ntz("payload.scheduled_event.created_at")))
    for i in range(3):
        b.filter(F.col("_part") == i).drop("_part").write.mode("append").parquet(bronze)
        # One drain per arrival: each micro-batch rewrites only the key buckets it touches (small ones here).
        jobs.silver_stream(spark, bronze, tdir, ck, SILVER_UPDATE, max_files=None, bucketed=True, rows_per_bucket=1_000)
    return jobs.read_bucketed(spark, tdir)


_PART_SQL = (f"CASE WHEN event_create_time < TIMESTAMP '{CUTS[0]}' THEN 0 "
             f"WHEN event_create_time < TIMESTAMP '{CUTS[1]}' THEN 1 ELSE 2 END")
_cols = ",\n  ".join(f"z.{c}" if c in SILVER_UPDATE else f"a.{c}" for c in _FLAT_COLS)
register("upsert_stream", f"""WITH f AS (SELECT *, {_PART_SQL} AS part FROM ({FLAT_SQL})),
firstp AS (SELECT invitee_id, MIN(part) AS p0 FROM f GROUP BY invitee_id),
a AS (SELECT f.* FROM f JOIN firstp USING (invitee_id) WHERE f.part = firstp.p0
      QUALIFY row_number() OVER (PARTITION BY invitee_id ORDER BY ingested_at DESC, event_start_time DESC) = 1),
z AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY invitee_id ORDER BY part DESC, ingested_at DESC,
      event_start_time DESC) = 1)
SELECT a.invitee_id, {_cols} FROM a JOIN z USING (invitee_id)""")(q_upsert_stream)


def q_stream_scd1(spark, sf):
    src, tdir, ck = (scratch_path(spark, n) for n in ("dept_changes", "dept_tbl", "ck_dept"))
    d = dept_weeks(spark, sf)
    k = _split_key()
    changed = d.filter((k % 2 == 0) | (k % 3 == 0)).withColumn("weekly_sales", (F.col("weekly_sales") + 1).cast("decimal(12,2)"))
    stamps = {0: T0, 1: T1}
    for arrival in (d.filter(k % 3 != 0), changed):
        arrival.write.mode("append").parquet(src)
        # Key-bucketed target: each micro-batch rewrites only the buckets it touches.
        jobs.change_stream_scd1(spark, src, d.schema, tdir, ck, ["store_id", "dept_id", "date"], max_files=None,
                                now_of_batch=lambda b: ts(stamps.get(b, T1)), bucketed=True, rows_per_bucket=1_000)
    return jobs.read_bucketed(spark, tdir)


from tidemark.plans.registry import ORACLE as _ORACLE  # noqa: E402

register("stream_scd1", _ORACLE["upsert_scd1"])(q_stream_scd1)


def q_delayed(spark, sf):
    """Leads and owners drained through the timers; a tick of the clock after the last wait then lets out the tail."""
    ld, od, cd, dst, ck = (scratch_path(spark, n) for n in ("leads_src", "owners_src", "clock_src", "enriched", "ck_enrich"))
    v_leads(spark, sf).write.parquet(ld)
    v_owners(spark, sf).write.parquet(od)
    wait = 12 * 3600
    last = spark.read.parquet(ld).agg(F.max("date_created").cast("timestamp").alias("at"))
    for tick in range(2):
        # The first tick is no later than the leads: the clock's files exist, the time stands still.
        at = last if not tick else last.select((F.col("at") + F.expr(f"INTERVAL {wait + 7200} SECONDS")).alias("at"))
        at.write.mode("append").parquet(cd)
        sources = [spark.readStream.schema(spark.read.parquet(d).schema).parquet(d) for d in (ld, od, cd)]
        out = jobs.delayed_enrich_stream(sources[0], sources[1], wait, clock=sources[2])
        jobs._drain(out.writeStream.format("parquet").option("path", dst).option("checkpointLocation", ck)
                    .outputMode("append"))
    return spark.read.parquet(dst).select("lead_id", "display_name", "lead_owner", "funnel")


# The stream itself gives what the batch form gives: every lead once.
register("delayed_enrich_stream", f"SELECT lead_id, display_name, lead_owner, funnel FROM ({LEADS_SQL})")(q_delayed)
