"""foreachBatch upserts: replayed batches are no-ops, empty batches skipped,
stream drain == batch result."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.upsert import read_table
from tidemark.streaming import jobs


@pytest.mark.parametrize("buckets", [None, 1])
def test_replayed_batch_is_noop(spark, tmp_path, buckets):
    d = str(tmp_path / "t")
    cb = jobs.foreach_batch_upsert(spark, d, ["k"], stamps=("ins", "upd"), **(dict(bucketed=True, rows_per_bucket=buckets) if buckets else {}),
                                   now_of_batch=lambda b: F.lit(f"2024-01-0{b + 1}").cast("timestamp_ntz"))
    read = (lambda: jobs.read_bucketed(spark, d)) if buckets else (lambda: read_table(spark, d))
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b1 = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    cb(b0, 0)
    cb(b1, 1)
    first = sorted((r.k, r.v, str(r.ins), str(r.upd)) for r in read().collect())
    cb(spark.createDataFrame([(2, "ZZZ")], "k int, v string"), 1)      # replay of batch 1: ignored
    cb(b1.limit(0), 2)                                                  # empty batch: skipped
    again = sorted((r.k, r.v, str(r.ins), str(r.upd)) for r in read().collect())
    assert first == again
    assert [x[:2] for x in first] == [(1, "a"), (2, "B"), (3, "c")]
    assert first[1][2].startswith("2024-01-01") and first[1][3].startswith("2024-01-02")


def test_incremental_ingest_loads_each_file_once(spark, tmp_path):
    src, dst, ck = str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "ck")
    df = spark.range(50).withColumn("v", F.col("id") * 2)
    df.filter("id < 25").write.parquet(src)
    jobs.ingest_stream(spark, src, df.schema, dst, ck, fmt="parquet", add_metadata=False)
    df.filter("id >= 25").write.mode("append").parquet(src)
    jobs.ingest_stream(spark, src, df.schema, dst, ck, fmt="parquet", add_metadata=False)
    jobs.ingest_stream(spark, src, df.schema, dst, ck, fmt="parquet", add_metadata=False)
    out = spark.read.parquet(dst)
    assert out.count() == 50 and out.select("id").distinct().count() == 50


def test_quarantine_adds_up_after_a_replay(spark, tmp_path, monkeypatch):
    """Good and bad rows of each batch become visible together, once, also where a batch died before its marker."""
    from pyspark.sql.types import IntegerType, StructField, StructType
    from tidemark.operators import upsert as U
    d = str(tmp_path / "t")
    cb = jobs.quarantine_batch(spark, StructType([StructField("k", IntegerType())]), d)
    batches = [spark.createDataFrame([(v, "f") for v in lines], "value string, source_file string")
               for lines in (['{"k": 1}', '{"k": 2', "x"], ['{"k": 3}', "{}", '{"k": "no"}'], ['{"k": 4}'])]
    seen = lambda: tuple(0 if (t := jobs.read_quarantined(spark, d, k)) is None else t.count() for k in ("good", "bad"))
    for i, want in enumerate([(1, 2), (3, 3), (4, 3)]):
        before = seen()
        with monkeypatch.context() as m:
            m.setattr(U.fs, "write_text", lambda *x, **y: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                cb(batches[i], i)
        assert seen() == before
        cb(batches[i], i)
        cb(batches[i], i)
        assert seen() == want
    assert {r[0] for r in jobs.read_quarantined(spark, d, "bad").select("_corrupt_record").collect()} == {'{"k": 2', "x", '{"k": "no"}'}


def test_leads_leave_at_their_timer_with_the_latest_owner(spark, tmp_path):
    """Owners before, inside, at the end of and after the wait, in later batches than their lead; ties; no user; the tail."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 9, 50)
    at = lambda minutes: t0 + dt.timedelta(minutes=minutes, microseconds=7)
    names = "lead_id long, user_id string, date_created timestamp_ntz", "owner_event_id long, owner_user_id string, owner_ts timestamp_ntz, lead_owner string"
    leads = [[(1, "u", at(0)), (2, "u", at(5)), (3, "v", at(0)), (4, None, at(1)), (5, "w", at(3))], [(6, "u", at(200))], [(7, "q", at(500))]]
    owners = [[(10, "u", at(-1), "early"), (11, "u", at(8), "a"), (12, "u", at(10), "at the end"), (13, "v", at(11), "late")],
              [(14, "u", at(14), "b"), (16, "u", at(14), "tie"), (15, "w", at(12), "second batch"), (17, "u", at(202), "c")], []]
    src = [str(tmp_path / n) for n in ("l", "o", "c")]
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    clock = [[(at(0),)], [(at(0),)], [(at(0),)], [(at(900),)], [(at(901),)]]
    for i in range(5):
        for path, rows, schema in ((src[0], leads[i] if i < 3 else [], names[0]), (src[1], owners[i] if i < 3 else [], names[1]),
                                   (src[2], clock[i], "at timestamp_ntz")):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        s = [spark.readStream.schema(spark.read.parquet(p).schema).parquet(p) for p in src]
        jobs._drain(jobs.delayed_enrich_stream(s[0], s[1], 600, "30 minutes", s[2]).writeStream.format("parquet")
                    .option("path", out).option("checkpointLocation", ck).outputMode("append"))
        if i == 1:
            early = {r.lead_id for r in spark.read.parquet(out).collect()}
    got = sorted((r.lead_id, r.lead_owner) for r in spark.read.parquet(out).collect())
    assert got == [(1, "at the end"), (2, "tie"), (3, None), (4, None), (5, "second batch"), (6, "c"), (7, None)]
    assert 4 in early and 7 not in early
    assert {r.date_created for r in spark.read.parquet(out).where("lead_id = 1").collect()} == {at(0)}


class _State:
    """What the state function of ``delayed_enrich_stream`` uses of a group's state."""

    def __init__(self, watermark_ms):
        self.kept, self.watermark, self.timer = None, watermark_ms, None

    exists = property(lambda self: self.kept is not None)
    get = property(lambda self: self.kept)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, kept):
        self.kept = kept

    def remove(self):
        self.kept = None

    def setTimeoutTimestamp(self, at):
        self.timer = at


def test_one_state_key_holds_many_users():
    """The users of a shard share a key; each lead still takes the last owner of its own user alone."""
    import pandas as pd
    second = 1_000_000
    rows = [(jobs.LEAD, t * second, u, -1, f"{u}{t}", None) for u in "abc" for t in (1, 5)] \
        + [(jobs.OWNER, t * second, u, tie, None, f"{u}{t}-{tie}") for u, t, tie in (("a", 2, 1), ("a", 9, 2), ("a", 9, 3), ("b", 4, 4), ("x", 6, 5))] \
        + [(jobs.LEAD, 3 * second, None, -1, "nobody", None)]
    pdf = pd.DataFrame(rows, columns=["kind", "micros", "key", "tie", "lead", "owner"])
    run, state, got = jobs._lead_timers(10 * second), _State(0), {}
    for now, batches in ((0, [pdf[:5], pdf[5:]]), (12_500, []), (30_000, [])):
        state.watermark = now
        new = {r.lead: r.owner for out in run((0, 1), batches, state) for r in out.itertuples()}
        assert not set(new) & set(got)
        got |= new
        if now == 12_500:
            assert {"a1", "b1", "c1"} <= set(got) and "a5" not in got and state.timer > now
    assert got == {"nobody": None, "a1": "a9-3", "a5": "a9-3", "b1": "b4-4", "b5": None, "c1": None, "c5": None}
    assert state.kept is None
