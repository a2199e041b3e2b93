"""Upserts (SCD1), history tables (SCD2) and file compaction on plain Parquet.

Without a table format, a table is a set of data directories plus commit
markers ``_commits/<n>.json``. A writer puts its files into a new directory of
its own and then commits a marker that names the directories of the version;
readers follow the highest marker. A writer that dies before its marker leaves
an unused directory and the retry succeeds. Single writer per table. All file
operations go through Hadoop's FileSystem API.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.materialize import materialize
from tidemark.sources import fs

COMMITS = "_commits"


class DuplicateKeyError(ValueError):
    pass


# ------------------------------------------------------------------ versioned table
def _active() -> SparkSession:
    s = SparkSession.getActiveSession()
    if s is None:
        raise RuntimeError("no active Spark session")
    return s


def current_version(table_dir: str, spark: SparkSession | None = None) -> dict | None:
    spark = spark or _active()
    names = [n for n in fs.list_names(spark, f"{table_dir}/{COMMITS}") if n.endswith(".json")]
    if not names:
        return None
    last = max(names, key=lambda n: int(n.split(".")[0]))
    return json.loads(fs.read_text(spark, f"{table_dir}/{COMMITS}/{last}"))


def read_table(spark: SparkSession, table_dir: str) -> DataFrame | None:
    cur = current_version(table_dir, spark)
    if cur is None:
        return None
    if "files" in cur:
        return spark.read.parquet(*[f"{table_dir}/{f}" for f in cur["files"]])
    return spark.read.parquet(f"{table_dir}/{cur['data']}")


def table_files(spark: SparkSession, table_dir: str, cur: dict) -> dict[str, int]:
    """Files of a version with their lengths."""
    folders = {f.split("/")[0] for f in cur["files"]} if "files" in cur else {cur["data"]}
    found = {f"{d}/{f}": n for d in sorted(folders) for f, n in fs.list_files(spark, f"{table_dir}/{d}").items()}
    return {f: found[f] for f in cur["files"]} if "files" in cur else found


def commit_files(spark: SparkSession, table_dir: str, cur: dict | None, files: Sequence[str], batch_id: int | None = None) -> int:
    """Commit a version that is the given files."""
    return commit(spark, table_dir, cur, batch_id=batch_id, files=list(files))


def append(df: DataFrame, table_dir: str, batch_id: int | None = None) -> int:
    """Commit a version of the files there are and those of ``df``."""
    spark, data = df.sparkSession, f"data-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "snappy").parquet(f"{table_dir}/{data}")
    cur = current_version(table_dir, spark)
    before = list(table_files(spark, table_dir, cur)) if cur else []
    return commit_files(spark, table_dir, cur, [*before, *[f"{data}/{f}" for f in fs.list_files(spark, f"{table_dir}/{data}")]], batch_id)


def commit(spark: SparkSession, table_dir: str, cur: dict | None, **content) -> int:
    """Create the marker of the version after ``cur``; a marker that is there already is an error."""
    nxt = 0 if cur is None else cur["version"] + 1
    fs.write_text(spark, f"{table_dir}/{COMMITS}/{nxt}.json", json.dumps({"version": nxt, **content}))
    return nxt


def publish(df: DataFrame, table_dir: str, batch_id: int | None = None, partition_by: Sequence[str] = (), **content) -> int:
    """Write ``df`` to a new directory, then commit it as the next version; ``content`` joins the marker."""
    data = f"data-{uuid.uuid4().hex}"
    w = df.write.mode("error").option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{table_dir}/{data}")
    spark = df.sparkSession
    return commit(spark, table_dir, current_version(table_dir, spark), batch_id=batch_id, data=data, **content)


# ------------------------------------------------------------------ SCD1 upsert
def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a merge source holds the same key twice (one bounded probe row)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate source key {dict(dup[0].asDict())}")


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, insert: bool = True,
           stamps: tuple[str, str] | None = None, now: Column | None = None,
           newer_only: str | None = None, check_keys: bool = True) -> DataFrame:
    """MERGE ``batch`` into ``target`` on ``keys`` and return the new table.

    matched rows: ``update_cols`` (default: every non-key batch column) take the
    batch value, other columns keep the target value; ``stamps = (insert_col,
    update_col)`` keeps the insert stamp and sets the update stamp to ``now``.
    unmatched batch rows are inserted when ``insert`` (both stamps = now).
    ``newer_only`` = a timestamp column: update only when the batch row is newer
    (the reference updates unconditionally, so this is off by default).
    One full-outer join on the keys, which are unique on both sides.
    """
    keys = list(keys)
    if check_keys:
        check_unique(batch, keys)
    now = now if now is not None else F.current_timestamp()
    bcols = [c for c in batch.columns if c not in keys]
    if target is None:
        out = batch
        if stamps:
            out = out.withColumns({stamps[0]: now, stamps[1]: now})
        return out
    ucols = list(update_cols) if update_cols is not None else bcols
    tcols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in tcols], F.lit(True).alias("_in_t"))
    b = batch.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in bcols], F.lit(True).alias("_in_b"))
    j = t.join(b, on=keys, how="full_outer" if insert else "left")
    in_t, in_b = F.col("_in_t").isNotNull(), F.col("_in_b").isNotNull()
    take_b = in_b
    if newer_only:
        take_b = in_b & (~in_t | (F.col(f"_b_{newer_only}") > F.col(f"_t_{newer_only}")))
    out = []
    for c in tcols:
        if stamps and c == stamps[0]:
            out.append(F.when(in_t, F.col(f"_t_{c}")).otherwise(now).alias(c))
        elif stamps and c == stamps[1]:
            out.append(F.when(take_b, now).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in ucols and c in bcols:
            out.append(F.when(take_b, F.col(f"_b_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in bcols:
            # not updated on match, but an inserted row carries the batch value
            out.append(F.when(in_t, F.col(f"_t_{c}")).otherwise(F.col(f"_b_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    extra = [F.col(f"_b_{c}").alias(c) for c in bcols if c not in tcols]
    return j.select(*keys, *out, *extra)


def add_missing_columns(target: DataFrame, columns: dict[str, str]) -> DataFrame:
    """ALTER TABLE ADD COLUMNS equivalent: new columns as typed NULLs."""
    return target.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in target.columns})


# ------------------------------------------------------------------ SCD2 history
def scd2_apply(history: DataFrame | None, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               now: Column, valid_from: str = "valid_from", valid_to: str = "valid_to",
               updated_at: str = "updated_at") -> DataFrame:
    """Apply a full load to a history table.

    New key -> open row; changed tracked value (NULL-safe compare) -> close the
    open row (valid_to = now) and open a new one; unchanged or absent key ->
    nothing. Closed rows pass through untouched. One join of open rows to the
    batch; each joined row emits up to two history rows (explode of a 2-array).
    """
    keys, tracked = list(keys), list(tracked)
    cols = keys + tracked
    if history is None:
        # valid_to: a NULL of the same type as ``now``
        return batch.select(*cols, now.alias(valid_from), F.when(F.lit(False), now).alias(valid_to),
                            now.alias(updated_at))
    closed = history.filter(F.col(valid_to).isNotNull())
    open_ = history.filter(F.col(valid_to).isNull())
    h = open_.select(*keys, *[F.col(c).alias(f"_h_{c}") for c in tracked], F.col(valid_from).alias("_h_vf"),
                     F.col(updated_at).alias("_h_ua"), F.lit(True).alias("_in_h"))
    b = batch.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in tracked], F.lit(True).alias("_in_b"))
    j = h.join(b, on=keys, how="full_outer")
    in_h, in_b = F.col("_in_h").isNotNull(), F.col("_in_b").isNotNull()
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"_h_{c}").eqNullSafe(F.col(f"_b_{c}"))
    changed = in_h & in_b & ~same
    ts_type = history.schema[valid_from].dataType.simpleString()
    old_row = F.when(in_h, F.struct(*[F.col(k).alias(k) for k in keys],
                                    *[F.col(f"_h_{c}").alias(c) for c in tracked],
                                    F.col("_h_vf").alias(valid_from),
                                    F.when(changed, now.cast(ts_type)).otherwise(F.lit(None).cast(ts_type))
                                    .alias(valid_to),
                                    F.col("_h_ua").alias(updated_at)))
    new_row = F.when(in_b & (~in_h | changed),
                     F.struct(*[F.col(k).alias(k) for k in keys], *[F.col(f"_b_{c}").alias(c) for c in tracked],
                              now.cast(ts_type).alias(valid_from), F.lit(None).cast(ts_type).alias(valid_to),
                              now.cast(ts_type).alias(updated_at)))
    rows = j.select(F.explode(F.array(old_row, new_row)).alias("r")).filter(F.col("r").isNotNull()).select("r.*")
    return closed.select(*cols, valid_from, valid_to, updated_at).unionByName(rows)


def scd2_current(history: DataFrame, valid_to: str = "valid_to") -> DataFrame:
    return history.filter(F.col(valid_to).isNull())


# ------------------------------------------------------------------ compaction
def compact(df: DataFrame, by: str, files: int | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Range-cluster on ``by``, sorted inside each partition, so Parquet min/max
    statistics skip row groups on ``by`` filters. The row multiset is unchanged.
    Without ``files`` the partition count follows the data (shuffle partitions,
    merged by AQE to its advisory size). ``tiebreak`` columns join the range key so
    a ``by`` value holding a large share of the rows is split over several tasks."""
    cols = [F.col(by), *[F.col(c) for c in tiebreak]]
    dealt = df.repartitionByRange(*cols) if files is None else df.repartitionByRange(files, *cols)
    return dealt.sortWithinPartitions(*cols)


# ------------------------------------------------------------------ bucketed upsert
KEY_BUCKET = "_kb"
ROWS_PER_KEY_BUCKET = 1_000_000
MANY_KEY_BUCKETS = 128       # beyond, smaller buckets than ROWS_PER_KEY_BUCKET grow with the table instead
RUNS_PER_BUCKET = 16         # directories of a bucket before a batch that touches it merges them


def bucket_rows(rows: int, rows_per_bucket: int) -> int:
    """Rows of a bucket in a table of ``rows``: small buckets only up to ``MANY_KEY_BUCKETS`` of them, each is a file a run."""
    return max(rows_per_bucket, min(ROWS_PER_KEY_BUCKET, rows // MANY_KEY_BUCKETS))


def key_bucket(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def _read_runs(spark: SparkSession, table_dir: str, cur: dict, runs: dict[str, list[dict]]) -> DataFrame | None:
    paths = [f"{table_dir}/{r['data']}/{KEY_BUCKET}={b}" for b, own in runs.items() for r in own]
    return spark.read.schema(cur["schema"]).parquet(*paths) if paths else None


def read_bucketed(spark: SparkSession, table_dir: str, only: Sequence[int] | None = None) -> DataFrame | None:
    """The committed rows of a bucketed table, or of the buckets ``only`` of it. None: no commit, or no such bucket."""
    cur = current_version(table_dir, spark)
    if cur is None:
        return None
    wanted = cur["buckets"] if only is None else {str(b): cur["buckets"][str(b)] for b in only if str(b) in cur["buckets"]}
    return _read_runs(spark, table_dir, cur, wanted)


def _ranges(rows: DataFrame, key: str, bucket: Column) -> DataFrame:
    return rows.groupBy(bucket.alias(KEY_BUCKET)).agg(F.min(key).alias("low"), F.max(key).alias("high"))


def _met_runs(spark: SparkSession, cur: dict, batch: DataFrame, keys: Sequence[str]) -> tuple[list[str], dict[str, list[dict]]]:
    """Buckets that the batch touches, and in them the runs whose range of the first key meets the batch's range there.

    A bucket with too many runs gives all of them. The tables compared hold one row per bucket and per run.
    """
    bucket, kind = key_bucket(keys, cur["n"]), batch.schema[keys[0]].dataType.simpleString()
    touched = _ranges(batch, keys[0], bucket)
    held = spark.createDataFrame([(int(b), i, r["low"], r["high"]) for b, own in cur["buckets"].items() for i, r in enumerate(own)],
                                 f"{KEY_BUCKET} int, i int, l string, h string")
    meet = (F.col("low") <= F.col("h").cast(kind)) & (F.col("high") >= F.col("l").cast(kind))
    rows = touched.join(held, KEY_BUCKET, "left").select(KEY_BUCKET, "i", F.coalesce(meet, F.lit(False)).alias("met")).collect()
    runs: dict[str, list[dict]] = {}
    for r in rows:
        own = cur["buckets"].get(str(r[0]), [])
        if r["i"] is not None and (r["met"] or len(own) >= RUNS_PER_BUCKET):
            runs.setdefault(str(r[0]), []).append(own[r["i"]])
    return sorted({str(r[0]) for r in rows}), runs


def upsert_bucketed(spark: SparkSession, table_dir: str, batch: DataFrame, keys: Sequence[str],
                    batch_id: int | None = None, rows_per_bucket: int = ROWS_PER_KEY_BUCKET, **upsert_opts) -> int:
    """MERGE ``batch`` into a table hash-bucketed on ``keys``, reading and rewriting only what it can meet.

    A bucket is a list of runs (directories), each with the range of its first key. A run whose range does not meet the
    batch's range in that bucket holds no row to update: it is neither read nor rewritten, and the batch's rows become a
    run beside it. Each batch writes a directory of its own; the marker then names the runs of every bucket, so the whole
    batch becomes visible at once and a retry after a crash starts from the old version. The number of buckets follows
    the row count: a table that outgrew twice its buckets is dealt anew. Returns the number of buckets written to. The
    driver holds bucket and run numbers only.
    """
    batch = batch.persist()
    try:
        return _upsert_bucketed(spark, table_dir, batch, list(keys), batch_id, rows_per_bucket, upsert_opts)
    finally:
        batch.unpersist()


def _upsert_bucketed(spark, table_dir, batch, keys, batch_id, rows_per_bucket, upsert_opts) -> int:
    cur = current_version(table_dir, spark)
    new = batch.count()
    if not new:
        return 0
    rows = new + (cur["rows"] if cur else 0)              # at most; a matched row counts twice until the table is dealt anew
    anew = cur is None or rows > 2 * bucket_rows(rows, rows_per_bucket) * cur["n"]
    if anew:
        target = read_bucketed(spark, table_dir)
        if target is not None:
            rows = new + target.count()
        n, kept = -(-rows // bucket_rows(rows, rows_per_bucket)), {}
    else:
        n = cur["n"]
        _, met = _met_runs(spark, cur, batch, keys)
        kept = {b: [r for r in own if r not in met.get(b, [])] for b, own in cur["buckets"].items()}
        target = _read_runs(spark, table_dir, cur, met)
        if target is None:
            target = spark.createDataFrame([], cur["schema"])
    merged = upsert(target, batch, keys, **upsert_opts)
    data = f"data-{uuid.uuid4().hex}"
    (merged.withColumn(KEY_BUCKET, key_bucket(keys, n)).repartition(n, KEY_BUCKET).write.mode("error")
     .option("compression", "snappy").partitionBy(KEY_BUCKET).parquet(f"{table_dir}/{data}"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in merged.schema.fields)
    folders = [x.split("=")[1] for x in fs.list_names(spark, f"{table_dir}/{data}") if x.startswith(f"{KEY_BUCKET}=")]
    written = {}
    if folders:
        made = spark.read.schema(f"{schema}, {KEY_BUCKET} int").parquet(f"{table_dir}/{data}")
        text = [F.col(c).cast("string").alias(c) for c in ("low", "high")]
        written = {str(r[0]): {"data": data, "low": r["low"], "high": r["high"]}
                   for r in _ranges(made, keys[0], F.col(KEY_BUCKET)).select(KEY_BUCKET, *text).collect()}
    buckets = {b: [*kept.get(b, []), *([written[b]] if b in written else [])] for b in sorted({*kept, *written}, key=int)}
    commit(spark, table_dir, cur, batch_id=batch_id, n=n, rows=rows, buckets={b: own for b, own in buckets.items() if own}, schema=schema)
    return len(written)


# ------------------------------------------------------------------ SCD2 on open / closed directories
def scd2_publish(spark: SparkSession, history_dir: str, batch: DataFrame, keys: Sequence[str],
                 tracked: Sequence[str], now: Column, load_id: int, valid_from: str = "valid_from",
                 valid_to: str = "valid_to", updated_at: str = "updated_at") -> None:
    """Apply one load to a history stored as ``open/`` (versioned) + ``closed/`` (append-only).

    Only the open rows (the current table) are read and rewritten, so the history size never drives the cost of a
    load. The rows that a load closes go to a directory of their own; the one marker under ``open/_commits`` names the
    open rows and every closed directory of its version. A reader sees a load whole or not at all, and a load that
    died before its marker leaves directories that no reader visits. A load whose id the marker records is skipped.
    """
    open_dir = f"{history_dir}/open"
    cur = current_version(open_dir, spark)
    if cur is not None and cur.get("batch_id") is not None and cur["batch_id"] >= load_id:
        return
    check_unique(batch, keys)
    open_rows = read_table(spark, open_dir)
    applied = scd2_apply(open_rows, batch, keys, tracked, now, valid_from, valid_to, updated_at)
    if open_rows is None:
        publish(applied, open_dir, batch_id=load_id, closed=[])      # a first load closes nothing
        return
    res = materialize(applied, "scd2_load")
    is_open = F.col(valid_to).isNull()
    closed = f"load={load_id}-{uuid.uuid4().hex}"
    res.filter(~is_open).write.mode("error").parquet(f"{history_dir}/closed/{closed}")
    publish(res.filter(is_open), open_dir, batch_id=load_id, closed=[*cur["closed"], closed])


def read_history(spark: SparkSession, history_dir: str) -> DataFrame | None:
    """Open and closed rows of the committed version: what its marker names, and nothing else."""
    cur = current_version(f"{history_dir}/open", spark)
    if cur is None:
        return None
    open_rows = spark.read.parquet(f"{history_dir}/open/{cur['data']}")
    if not cur["closed"]:
        return open_rows
    closed = spark.read.schema(open_rows.schema).parquet(*[f"{history_dir}/closed/{d}" for d in cur["closed"]])
    return open_rows.unionByName(closed)
