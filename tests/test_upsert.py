import pytest
from pyspark.sql import functions as F

from tidemark.operators import upsert as U


def ts(v):
    return F.lit(v).cast("timestamp_ntz")


def test_scd1_merge(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").withColumns(
        {"ins": ts("2024-01-01"), "upd": ts("2024-01-01")})
    b = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    out = {r.k: r for r in U.upsert(t, b, ["k"], stamps=("ins", "upd"), now=ts("2024-02-01")).collect()}
    assert out[1].v == "a" and out[2].v == "B" and out[3].v == "c"
    assert str(out[2].ins).startswith("2024-01-01") and str(out[2].upd).startswith("2024-02-01")
    assert str(out[3].ins).startswith("2024-02-01")


def test_duplicate_source_key_raises(spark):
    b = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(U.DuplicateKeyError):
        U.upsert(b.limit(0), b, ["k"])


def test_upsert_twice_equals_once(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(1, "z"), (2, "q")], "k int, v string")
    once = U.upsert(t, b, ["k"])
    twice = U.upsert(once, b, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_newer_only(spark):
    t = spark.createDataFrame([(1, "new", 5)], "k int, v string, t int")
    b = spark.createDataFrame([(1, "old", 3)], "k int, v string, t int")
    assert U.upsert(t, b, ["k"], newer_only="t").first().v == "new"
    assert U.upsert(t, b, ["k"]).first().v == "old"


def test_scd2_invariants(spark):
    l1 = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None)], "k int, x double")
    l2 = spark.createDataFrame([(1, 10.0), (2, 21.0), (3, 5.0), (4, 1.0)], "k int, x double")
    h = U.scd2_apply(None, l1, ["k"], ["x"], ts("2024-01-01"))
    h2 = U.scd2_apply(h, l2, ["k"], ["x"], ts("2024-02-01"))
    opened = h2.filter(F.col("valid_to").isNull()).groupBy("k").count()
    assert opened.filter(F.col("count") > 1).count() == 0
    assert h2.count() == 6          # 1 unchanged, 2 and 3 changed (closed + new), 4 new
    cur = {r.k: r.x for r in U.scd2_current(h2).collect()}
    assert cur == {1: 10.0, 2: 21.0, 3: 5.0, 4: 1.0}


def test_publish_pointer_and_compaction(spark, tmp_path):
    d = str(tmp_path / "tbl")
    df = spark.range(100).withColumn("g", F.col("id") % 7)
    assert U.publish(df, d) == 0
    assert U.publish(U.compact(df, "g", 3), d) == 1
    back = U.read_table(spark, d)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_bucketed_upsert_rewrites_only_touched(spark, tmp_path):
    d = str(tmp_path / "tbl")
    t = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    U.upsert_bucketed(spark, d, t, ["k"], rows_per_bucket=20)
    before = U.current_version(d, spark)["buckets"]
    b = spark.createDataFrame([(5, -1), (500, 7)], "k long, v long")
    n = U.upsert_bucketed(spark, d, b, ["k"], rows_per_bucket=20)
    assert len(before) == 10 and 1 <= n <= 2
    got = {r.k: r.v for r in U.read_bucketed(spark, d).collect()}
    assert len(got) == 201 and got[5] == -1 and got[500] == 7 and got[6] == 60
    after = U.current_version(d, spark)["buckets"]
    assert sum(1 for x in after if after[x] != before.get(x)) == n
    U.upsert_bucketed(spark, d, spark.range(1000, 2000).select(F.col("id").alias("k"), F.lit(0).alias("v")), ["k"], rows_per_bucket=20)
    assert U.current_version(d, spark)["n"] == 61 and U.read_bucketed(spark, d).count() == 1201      # dealt anew


def test_bucketed_upsert_prunes_by_key_range(spark, tmp_path, monkeypatch):
    """Keys beyond a run's range: its directory stays and is not read; keys inside: only the runs they can meet are."""
    d, read = str(tmp_path / "tbl"), []
    rows = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    real = U._read_runs
    monkeypatch.setattr(U, "_read_runs", lambda s, t, cur, runs: read.append(runs) or real(s, t, cur, runs))
    U.upsert_bucketed(spark, d, rows(0, 100, "a"), ["k"], rows_per_bucket=100)
    first = U.current_version(d, spark)["buckets"]
    U.upsert_bucketed(spark, d, rows(100, 150, "b"), ["k"], rows_per_bucket=100)
    second = U.current_version(d, spark)["buckets"]
    assert read[-1] == {} and len(first) == 1 and second["0"][0] == first["0"][0] and len(second["0"]) == 2
    U.upsert_bucketed(spark, d, rows(120, 160, "c"), ["k"], rows_per_bucket=100)
    third = U.current_version(d, spark)["buckets"]
    assert read[-1] == {"0": [second["0"][1]]} and third["0"][0] == first["0"][0]
    got = {r.k: r.v for r in U.read_bucketed(spark, d).collect()}
    assert got == {i: "a" if i < 100 else "b" if i < 120 else "c" for i in range(160)}
    # Text and date keys keep their order; a bucket of too many runs is merged by the next batch that touches it.
    monkeypatch.setattr(U, "RUNS_PER_BUCKET", 2)
    U.upsert_bucketed(spark, d, rows(500, 505, "z"), ["k"], rows_per_bucket=100)
    assert len(U.current_version(d, spark)["buckets"]["0"]) == 1 and U.read_bucketed(spark, d).count() == 165


@pytest.mark.parametrize("bucketed", [False, True])
def test_crash_before_the_marker_then_retry(spark, tmp_path, monkeypatch, bucketed):
    from tidemark.streaming import jobs
    a = spark.createDataFrame([(i, "a") for i in range(40)], "k int, v string")
    b = spark.createDataFrame([(i, "b") for i in range(20, 60)], "k int, v string")
    opts = dict(bucketed=True, rows_per_bucket=8) if bucketed else {}
    read = (lambda d: U.read_bucketed(spark, d)) if bucketed else (lambda d: U.read_table(spark, d))
    clean, broken = str(tmp_path / "clean"), str(tmp_path / "broken")
    for d in (clean, broken):
        cb = jobs.foreach_batch_upsert(spark, d, ["k"], **opts)
        for i, batch in enumerate((a, b)):
            if d == broken:
                with monkeypatch.context() as m:
                    m.setattr(U.fs, "write_text", lambda *x, **y: (_ for _ in ()).throw(OSError("lost")))
                    with pytest.raises(OSError):
                        cb(batch, i)                 # files written, marker not
                if i:
                    assert read(d).count() == 40     # readers still see the version before
            cb(batch, i)
            cb(batch, i)                             # replay: no-op
    rows = [sorted(map(tuple, read(d).collect())) for d in (clean, broken)]
    assert rows[0] == rows[1] and len(rows[0]) == 60


def test_scd2_publish_open_closed(spark, tmp_path):
    d = str(tmp_path / "hist")
    l1 = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, x double")
    l2 = spark.createDataFrame([(1, 11.0), (2, 20.0), (3, 3.0)], "k int, x double")
    U.scd2_publish(spark, d, l1, ["k"], ["x"], ts("2024-01-01"), load_id=1)
    U.scd2_publish(spark, d, l2, ["k"], ["x"], ts("2024-02-01"), load_id=2)
    U.scd2_publish(spark, d, l2, ["k"], ["x"], ts("2024-03-01"), load_id=2)   # replayed load: skipped
    h = U.read_history(spark, d)
    assert h.count() == 4
    assert U.read_table(spark, d + "/open").count() == 3
    closed = h.filter(F.col("valid_to").isNotNull()).collect()
    assert [(r.k, r.x) for r in closed] == [(1, 10.0)]


@pytest.mark.parametrize("lost", ["open rows", "marker"])
def test_scd2_crash_shows_the_old_state(spark, tmp_path, monkeypatch, lost):
    """A load that dies after its closed rows, before or after its open rows, is not seen; its retry is seen once."""
    d = str(tmp_path / "hist")
    l1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    l2 = spark.createDataFrame([(1, "c"), (2, "b"), (3, "d")], "k int, x string")
    assert U.read_history(spark, d) is None
    U.scd2_publish(spark, d, l1, ["k"], ["x"], ts("2024-01-01"), load_id=1)
    before = sorted(map(str, U.read_history(spark, d).collect()))
    with monkeypatch.context() as m:
        if lost == "marker":
            m.setattr(U.fs, "write_text", lambda *x, **y: (_ for _ in ()).throw(OSError("lost")))
        else:
            m.setattr(U, "publish", lambda *x, **y: (_ for _ in ()).throw(OSError("lost")))
        for _ in range(2):
            with pytest.raises(OSError):
                U.scd2_publish(spark, d, l2, ["k"], ["x"], ts("2024-02-01"), load_id=2)
    assert U.fs.list_names(spark, f"{d}/closed")                                   # written, never committed
    assert sorted(map(str, U.read_history(spark, d).collect())) == before
    U.scd2_publish(spark, d, l2, ["k"], ["x"], ts("2024-02-01"), load_id=2)
    got = sorted((r.k, r.x, r.valid_to is None) for r in U.read_history(spark, d).collect())
    assert got == [(1, "a", False), (1, "c", True), (2, "b", True), (3, "d", True)]
    U.scd2_publish(spark, d, l2.filter("k > 1"), ["k"], ["x"], ts("2024-03-01"), load_id=3)
    assert U.read_history(spark, d).count() == 4                                  # nothing closed, nothing lost


def test_scd2_intervals_do_not_overlap(spark):
    l1 = spark.createDataFrame([(1, 1.0)], "k int, x double")
    h = U.scd2_apply(None, l1, ["k"], ["x"], ts("2024-01-01"))
    for i, day in enumerate(["2024-02-01", "2024-03-01", "2024-04-01"]):
        h = U.scd2_apply(h, spark.createDataFrame([(1, float(i + 2))], "k int, x double"), ["k"], ["x"], ts(day))
    rows = sorted((r.valid_from, r.valid_to) for r in h.collect())
    assert len(rows) == 4 and rows[-1][1] is None
    for (f1, t1), (f2, _) in zip(rows, rows[1:]):
        assert t1 == f2 and f1 < t1


def test_small_buckets_do_not_multiply_with_the_rows(spark, tmp_path, monkeypatch):
    """Every bucket is a file a run: beyond some hundreds, small buckets grow with the table; the rows stay right."""
    assert -(-216_000_000 // U.bucket_rows(216_000_000, 1_000)) <= 217 and U.bucket_rows(90_000, 1_000) == 1_000
    assert U.bucket_rows(10**10, 1_000) == U.ROWS_PER_KEY_BUCKET and U.bucket_rows(10**10, 5_000_000) == 5_000_000
    monkeypatch.setattr(U, "MANY_KEY_BUCKETS", 4)
    d = str(tmp_path / "t")
    for i, (low, high) in enumerate(((0, 40), (20, 60), (50, 70))):
        U.upsert_bucketed(spark, d, spark.range(low, high).selectExpr("id AS k", f"{i} AS v"), ["k"], batch_id=i, rows_per_bucket=1)
        assert U.current_version(d, spark)["n"] <= 4
    assert {r.k: r.v for r in U.read_bucketed(spark, d).collect()} == {k: 0 if k < 20 else 1 if k < 50 else 2 for k in range(70)}
