"""Incremental jobs on Structured Streaming.

All jobs drain what is available and stop (``trigger(availableNow=True)``);
progress lives in the checkpoint, so a rerun only processes new files and a
replayed micro-batch is recognised by the batch id stored with the table
version.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.events import flatten_event
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.upsert import commit, current_version, publish, read_bucketed, read_table, upsert, upsert_bucketed


def _drain(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def ingest_stream(spark: SparkSession, src: str, schema: StructType, dst: str, checkpoint: str,
                  fmt: str = "json", options: dict | None = None, add_metadata: bool = True,
                  max_files: int | None = None) -> None:
    """New files under ``src`` -> appended to the Parquet table ``dst``.

    Adds ``ingested_at`` and ``source_file`` (bronze metadata). The checkpoint
    records processed files: a file is never loaded twice.
    """
    r = spark.readStream.schema(schema).format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.load(src)
    if add_metadata:
        df = df.withColumns({"ingested_at": F.current_timestamp(), "source_file": F.col("_metadata.file_path")})
    _drain(df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", dst)
           .outputMode("append"))


def quarantine_stream(spark: SparkSession, src: str, schema: StructType, dst: str, checkpoint: str,
                      max_files: int | None = None, corrupt: str = "_corrupt_record") -> None:
    """New JSON-line files under ``src`` -> good rows and quarantined lines of the table ``dst``.

    Each micro-batch parses its lines once, writes good and bad rows to directories of its own, and commits one marker
    with both and the batch id: a reader sees a batch whole or not at all, and a replayed batch is a no-op, so good and
    bad rows add up to the lines read. Read them with :func:`read_quarantined`.
    """
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    lines = r.load(src).select("value", F.col("_metadata.file_path").alias("source_file"))
    _drain(lines.writeStream.foreachBatch(quarantine_batch(spark, schema, dst, corrupt)).option("checkpointLocation", checkpoint))


def quarantine_batch(spark: SparkSession, schema: StructType, dst: str, corrupt: str = "_corrupt_record") -> Callable[[DataFrame, int], None]:
    """Callback of :func:`quarantine_stream`: rows (value, source_file) of one batch to both sinks, and the marker."""
    full = StructType([*schema.fields, StructField(corrupt, StringType())])

    def callback(batch: DataFrame, batch_id: int) -> None:
        cur = current_version(dst, spark)
        if cur is not None and cur["batch_id"] >= batch_id:
            return
        parsed = batch.select("source_file", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("j"))
        parsed = parsed.select("j.*", "source_file").withColumn("ingested_at", F.current_timestamp()).persist()
        name = uuid.uuid4().hex
        try:
            parsed.where(F.col(corrupt).isNull()).drop(corrupt).write.parquet(f"{dst}/good/{name}")
            parsed.where(F.col(corrupt).isNotNull()).select(corrupt, "source_file", "ingested_at").write.parquet(f"{dst}/bad/{name}")
        finally:
            parsed.unpersist()
        commit(spark, dst, cur, batch_id=batch_id, batches=[*(cur["batches"] if cur else []), name])

    return callback


def read_quarantined(spark: SparkSession, dst: str, kind: str) -> DataFrame | None:
    """The committed ``good`` or ``bad`` rows of :func:`quarantine_stream`; None before the first batch."""
    cur = current_version(dst, spark)
    return spark.read.parquet(*[f"{dst}/{kind}/{b}" for b in cur["batches"]]) if cur else None


def foreach_batch_upsert(spark: SparkSession, table_dir: str, keys: Sequence[str],
                         update_cols: Sequence[str] | None = None, dedupe_ts: str | None = None,
                         dedupe_tiebreak: Sequence[str] = (), stamps: tuple[str, str] | None = None,
                         now_of_batch: Callable[[int], Column] | None = None,
                         newer_only: str | None = None, bucketed: bool = False,
                         **bucket_opts) -> Callable[[DataFrame, int], None]:
    """Callback for ``foreachBatch``: dedupe the batch, MERGE it, commit.

    Empty batches are skipped. The batch id is stored in the commit marker of
    the table, so a batch replayed after a failure is a no-op, and a batch that
    died before its marker left nothing visible. ``bucketed``: the table is
    hash-bucketed on the keys and only the buckets a batch touches are rewritten
    (:func:`tidemark.operators.upsert.upsert_bucketed`, which takes ``bucket_opts``).
    """
    def callback(batch: DataFrame, batch_id: int) -> None:
        cur = current_version(table_dir, spark)
        if cur is not None and cur.get("batch_id") is not None and cur["batch_id"] >= batch_id:
            return
        if dedupe_ts:
            batch = latest_per_key(batch, keys, dedupe_ts, dedupe_tiebreak)
        now = now_of_batch(batch_id) if now_of_batch else F.current_timestamp()
        opts = dict(update_cols=update_cols, stamps=stamps, now=now, newer_only=newer_only)
        if bucketed:
            upsert_bucketed(spark, table_dir, batch, keys, batch_id, **bucket_opts, **opts)
            return
        batch = batch.persist()        # read by the emptiness test, the key check and the merge
        try:
            if not batch.isEmpty():
                publish(upsert(read_table(spark, table_dir), batch, keys, **opts), table_dir, batch_id=batch_id)
        finally:
            batch.unpersist()

    return callback


def silver_stream(spark: SparkSession, bronze_dir: str, table_dir: str, checkpoint: str,
                  update_cols: Sequence[str], max_files: int | None = 1, bucketed: bool = False,
                  **bucket_opts) -> None:
    """Bronze table stream -> flatten -> per batch latest per invitee -> partial upsert."""
    schema = spark.read.parquet(bronze_dir).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    flat = flatten_event(r.parquet(bronze_dir))
    cb = foreach_batch_upsert(spark, table_dir, ["invitee_id"], update_cols=update_cols, dedupe_ts="ingested_at",
                              dedupe_tiebreak=["event_start_time"], bucketed=bucketed, **bucket_opts)
    _drain(flat.writeStream.foreachBatch(cb).option("checkpointLocation", checkpoint))


def change_stream_scd1(spark: SparkSession, src: str, schema: StructType, table_dir: str, checkpoint: str,
                       keys: Sequence[str], now_of_batch: Callable[[int], Column], fmt: str = "parquet",
                       max_files: int | None = 1, bucketed: bool = False, **bucket_opts) -> None:
    """Append-only change files -> SCD1 merge per micro-batch (only when data arrived)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.format(fmt).load(src)
    cb = foreach_batch_upsert(spark, table_dir, keys, stamps=("insert_dts", "update_dts"), now_of_batch=now_of_batch,
                              bucketed=bucketed, **bucket_opts)
    _drain(df.writeStream.foreachBatch(cb).option("checkpointLocation", checkpoint))


LEAD, OWNER, CLOCK = 0, 1, 2
SHARDS = 128            # groups of users per time slot of delayed_enrich_stream


def delayed_enrich_stream(leads: DataFrame, owners: DataFrame, wait_seconds: int, delay: str = "1 hour",
                          clock: DataFrame | None = None, shards: int = SHARDS) -> DataFrame:
    """Each lead once, with the latest owner record within ``wait_seconds`` after it, emitted when its wait is over.

    Leads and owners are one stream keyed by (shard, time slot); a shard is a hash group of users, so the number of keys
    follows ``shards`` and the time, not the users. The state of a key holds its waiting leads and the owner
    records of its slot; an event-time timer stands at the end of the earliest wait. When the watermark passes it, each lead
    that is due leaves as one row with the last owner of its user not after its wait (ties: the larger ``owner_event_id``), or
    with NULL owner fields. An owner is listed under its own slot of ``wait_seconds`` and the next, so a lead finds all
    of its owners under the slot where its wait ends. Rows that come more than ``delay`` behind the watermark are too late,
    as in any stream. ``clock`` (a column ``at``) carries the time on where no events
    do: its rows raise the watermark and nothing else, so the last leads of a quiet stream are emitted too. Rows
    without user or time take no part on the owners' side; such leads come out at once, without an owner. ``shards`` is
    fixed for the life of a checkpoint. Columns: those of ``leads`` and ``owners``; event times are TIMESTAMP.
    """
    l = leads.withColumn("date_created", F.col("date_created").cast("timestamp"))
    o = owners.withColumn("owner_ts", F.col("owner_ts").cast("timestamp"))
    wait = F.expr(f"INTERVAL {int(wait_seconds)} SECONDS")
    slot = lambda t: F.floor(F.unix_micros(t) / F.lit(wait_seconds * 1_000_000))
    none = lambda df: F.lit(None).cast(df.schema)
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    kinds = [l.select(F.lit(LEAD).alias("kind"), F.col("user_id").cast("string").alias("key"), slot(F.col("date_created") + wait).alias("slot"),
                      F.col("date_created").alias("at"), F.struct("*").alias("lead"), none(o).alias("owner"))]
    own = slot(F.col("owner_ts"))
    kinds.append(o.dropna(subset=["owner_ts", "owner_user_id"]).select(
        F.lit(OWNER).alias("kind"), F.col("owner_user_id").cast("string").alias("key"), F.explode(F.array(own, own + 1)).alias("slot"),
        F.col("owner_ts").alias("at"), none(l).alias("lead"), F.struct("*").alias("owner")))
    if clock is not None:
        kinds.append(clock.select(F.lit(CLOCK).alias("kind"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("long").alias("slot"),
                                  F.col("at").cast("timestamp").alias("at"), none(l).alias("lead"), none(o).alias("owner")))
    rows = reduce(DataFrame.unionByName, kinds).withWatermark("at", delay)
    packed = rows.select("kind", "key", "slot", "at", F.unix_micros("at").alias("micros"), F.to_json("lead", exact).alias("lead"),
                         F.to_json("owner", exact).alias("owner"), F.coalesce(F.col("owner.owner_event_id").cast("long"), F.lit(-1)).alias("tie"))
    # Leads without a user wait for nobody: any shard will do, so they do not meet in one.
    shard = F.pmod(F.xxhash64("key", F.when(F.col("key").isNull(), F.col("lead"))), F.lit(shards))
    found = packed.withColumn("shard", shard).groupBy("shard", "slot").applyInPandasWithState(
        _lead_timers(wait_seconds * 1_000_000), "lead string, owner string",
        "lead_at array<long>, lead_user array<string>, lead array<string>, "
        "owner_at array<long>, owner_user array<string>, tie array<long>, owner array<string>",
        "append", "EventTimeTimeout")
    return found.select(F.from_json("lead", l.schema, exact).alias("l"), F.from_json("owner", o.schema, exact).alias("o")) \
        .select("l.*", "o.*")


def _lead_timers(wait: int) -> Callable:
    """State function of one (shard, slot): keep leads and owners, emit the leads whose wait is over."""
    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = [list(part) for part in state.get] if state.exists else [[] for _ in range(7)]
        leads, owners = list(zip(*held[:3])), list(zip(*held[3:]))      # (micros, user, row), (micros, user, tie, row)
        for pdf in batches:
            for kind, micros, user, tie, lead, owner in zip(*(pdf[c].tolist() for c in ("kind", "micros", "key", "tie", "lead", "owner"))):
                if kind == LEAD:
                    leads.append((None if pd.isna(micros) else int(micros), user, lead))
                elif kind == OWNER:
                    owners.append((int(micros), user, tie, owner))
        now = state.getCurrentWatermarkMs() * 1000
        due, waiting = [], []
        for x in leads:
            (due if x[0] is None or x[1] is None or x[0] + wait < now else waiting).append(x)
        found = sorted((user, micros, tie, row) for micros, user, tie, row in owners) if due else []
        out = []
        for micros, user, lead in due:
            # The last record of the user up to the end of the wait, if it is not before the lead.
            at = bisect_right(found, (user, micros + wait, math.inf)) if micros is not None and user is not None else 0
            fits = at and found[at - 1][0] == user and found[at - 1][1] >= micros
            out.append((lead, found[at - 1][3] if fits else None))
        end = (int(key[1]) + 1) * wait if key[1] is not None and not pd.isna(key[1]) else None   # no lead of this slot waits longer
        if end is None or not waiting and end < now:
            state.remove()
        else:
            state.update(tuple([x[i] for x in rows] for rows, width in ((waiting, 3), (owners, 4)) for i in range(width)))
            # Timers lie ahead of the watermark; the slot's own end clears owners that no lead asked for.
            at = min([x[0] + wait for x in waiting], default=end)
            state.setTimeoutTimestamp(max(at // 1000 + 1, now // 1000 + 1))
        if out:
            yield pd.DataFrame(out, columns=["lead", "owner"])

    return run
