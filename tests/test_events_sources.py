import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.functions.columns import safe_ratio
from tidemark.operators import events as EV
from tidemark.operators.ranking import latest_per_key, top_k
from tidemark.sources.readers import read_dated, read_evolving, read_json


def test_unwrap_envelope_forms(spark):
    rows = [('{"body": "{\\"event\\": {\\"lead_id\\": 7}}"}',), ('{"event": {"lead_id": 8}}',),
            ('{"other": 1}',), ('{"event": {"name": "x"}}',), ('{"event": ',)]
    df = spark.createDataFrame(rows, "raw string")
    _, lead, ok = EV.unwrap_envelope(F.col("raw"))
    got = [(r.lead, r.ok) for r in df.select(lead.alias("lead"), ok.alias("ok")).collect()]
    assert got == [("7", True), ("8", True), ("unknown_lead", True), (None, True), (None, False)]


def test_parse_json_corrupt_split(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": ',)], "t string")
    good, bad = EV.split_corrupt(EV.parse_json_column(df, "t", StructType([StructField("k", IntegerType())])))
    assert [r.k for r in good.collect()] == [1] and bad.count() == 1


def test_read_json_files_good_and_bad(spark, tmp_path):
    p = tmp_path / "e.json"
    p.write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    good, bad = read_json(spark, str(p), StructType([StructField("a", IntegerType())]))
    assert sorted(r.a for r in good.collect()) == [1, 3] and bad.count() == 1


def test_flatten_event_short_uri_and_memberships(spark):
    raw = ('{"event": "invitee.created", "payload": {"uri": "https://x/y", "scheduled_event": '
           '{"start_time": "2024-01-02T03:04:05.000001", "event_memberships": [{"user_name": "a"}, '
           '{"user_name": "b"}]}}}')
    df = spark.createDataFrame([(raw,)], "raw string").select(
        F.from_json("raw", EV.EVENT_SCHEMA).alias("j"), F.current_timestamp().alias("ingested_at")).select(
        "j.*", "ingested_at")
    r = EV.flatten_event(df).first()
    assert r.invitee_id is None and r.host_user_names == "a, b"
    assert r.event_start_time == dt.datetime(2024, 1, 2, 3, 4, 5, 1)


def test_safe_ratio_zero_divisor(spark):
    df = spark.createDataFrame([(5, 0), (5, 2), (None, 2)], "a int, b int")
    assert [r.x for r in df.select(safe_ratio("a", "b").alias("x")).collect()] == [None, 2.5, None]


def test_cost_per_booking_zero_bookings(spark):
    from tidemark.plans.bookings import cost_per_booking
    spend = spark.createDataFrame([("2024-01-01", "fb", 10.0), ("2024-01-02", "fb", 8.0)],
                                  "date string, channel string, spend double")
    mapping = spark.createDataFrame([("fb", "uri-fb")], "channel_name string, event_type_uri string")
    silver = spark.createDataFrame([("uri-fb", dt.datetime(2024, 1, 1, 9))] * 4,
                                   "event_type string, event_start_time timestamp_ntz")
    got = {str(r.spend_date): (r.meetings_booked, r.cost_per_booking)
           for r in cost_per_booking(spend, silver, mapping).collect()}
    assert got == {"2024-01-01": (4, 2.5), "2024-01-02": (0, 8.0)}


def test_dated_read_missing_file_fails_loudly(spark, tmp_path):
    sch = StructType([StructField("date", StringType())])
    with pytest.raises(FileNotFoundError):
        read_dated(spark, str(tmp_path / "spend_{date}.json"), dt.date(2024, 1, 5), sch)


def test_schema_evolution_added_missing_widened_mixed(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, 10)], "id int, n int").write.parquet(a)                 # int key, int n
    spark.createDataFrame([(2, "x", "z")], "id bigint, n string, extra string").write.parquet(b)
    target = StructType([StructField("id", LongType()), StructField("n", StringType()),
                         StructField("extra", StringType()), StructField("score", DoubleType())])
    got = sorted(tuple(r) for r in read_evolving(spark, [a, b], target).collect())
    assert got == [(1, "10", None, None), (2, "x", "z", None)]


def test_top_k_nulls_last_and_ties(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", None), ("c", 3.0), ("d", 1.0)], "p string, v double")
    assert [r.p for r in top_k(df, "v", 3, desc=True, tiebreak=["p"]).collect()] == ["a", "c", "d"]
    assert [r.p for r in top_k(df, "v", 2, desc=False, tiebreak=["p"]).collect()] == ["d", "a"]


def test_latest_per_key_tiebreak(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 3, "z"), (2, 1, "w")], "k int, t int, v string")
    assert sorted((r.k, r.v) for r in latest_per_key(df, ["k"], "t", ["v"]).collect()) == [(1, "y"), (2, "w")]


def test_scalar_attach_has_no_join(spark):
    from tidemark.plans.restaurant import attach_scalar
    df = spark.range(10)
    out = attach_scalar(df, df.agg(F.max("id").alias("mx")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan
    assert {r.mx for r in out.collect()} == {9}


def test_within_join_matches_plain_range_join(spark):
    import random
    from tidemark.operators.joins import within_join
    r = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    leads = spark.createDataFrame(
        [(i, "hot" if i % 3 else f"u{i % 5}", base + dt.timedelta(seconds=r.randint(0, 40000))) for i in range(300)],
        "lid int, u string, t timestamp_ntz")
    owners = spark.createDataFrame(
        [(j, "hot" if j % 2 else f"u{j % 5}", base + dt.timedelta(seconds=r.randint(0, 40000))) for j in range(300)],
        "oid int, ou string, ot timestamp_ntz")
    got = within_join(leads, owners, [("u", "ou")], "t", "ot", 600, how="left").select("lid", "oid")
    cond = (leads.u == owners.ou) & (owners.ot >= leads.t) & (owners.ot <= leads.t + F.expr("INTERVAL 600 SECONDS"))
    exp = leads.join(owners, cond, "left").select("lid", "oid")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exp.collect()), key=repr)


def test_write_partitioned_spreads_hot_partition(spark, tmp_path):
    from tidemark.sources.readers import write_partitioned
    df = spark.range(3000).withColumn("p", F.when(F.col("id") < 2000, F.lit("hot")).otherwise(
        (F.col("id") % 5).cast("string")))
    out = str(tmp_path / "w")
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        write_partitioned(df.repartition(8), out, ["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)
    write_partitioned(df, str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 3000
    import os
    hot_files = [f for f in os.listdir(os.path.join(out, "p=hot")) if f.endswith(".parquet")]
    assert len(hot_files) >= 2
    back = spark.read.parquet(out)
    assert back.count() == 3000 and back.filter("p = 'hot'").count() == 2000


def test_latest_within_matches_join(spark):
    from tidemark.operators.joins import latest_within
    r = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    at = lambda: None if r.random() < 0.05 else base + dt.timedelta(seconds=r.randint(0, 4000))
    who = lambda: None if r.random() < 0.05 else "hot" if r.random() < 0.6 else f"u{r.randint(0, 3)}"
    left = spark.createDataFrame([(i, who(), at()) for i in range(300)], "lid int, u string, t timestamp_ntz")
    right = spark.createDataFrame([(i, who(), at()) for i in range(300)], "oid int, ou string, ot timestamp_ntz")
    got = {x.lid: x.oid for x in latest_within(left, right, [("u", "ou")], "t", "ot", 600, ["oid"]).collect()}
    owners = right.collect()
    want = {}
    for x in left.collect():
        hits = [o for o in owners if x.u and x.t and o.ot and o.ou == x.u and x.t <= o.ot <= x.t + dt.timedelta(seconds=600)]
        want[x.lid] = max(hits, key=lambda o: (o.ot, o.oid)).oid if hits else None
    assert got == want
    assert latest_within(left.limit(0), right, [("u", "ou")], "t", "ot", 600).count() == 0


def test_joined_types_do_not_depend_on_the_order():
    from itertools import permutations
    from pyspark.sql.types import StructType
    from tidemark.sources.readers import join_schemas
    kinds = {"byte int": "int", "int bigint": "bigint", "int bigint string": "string", "int double": "double", "bigint decimal(10,2)": "decimal(21,2)",
             "decimal(10,2) decimal(8,4)": "decimal(12,4)", "decimal(38,0) decimal(38,30)": "string", "date timestamp": "timestamp", "boolean int": "string",
             "float double": "double", "array<int> array<bigint>": "array<bigint>", "struct<a:int> struct<A:bigint,b:string>": "struct<a:bigint,b:string>"}
    for have, want in kinds.items():
        for order in permutations(have.split()):
            got = join_schemas([StructType.fromDDL(f"x {t}") for t in order])["x"].dataType.simpleString().lower()
            assert sorted(got.replace("struct<", "").strip(">").split(",")) == sorted(want.replace("struct<", "").strip(">").split(",")), (order, got)


def test_evolving_parts_without_a_schema(spark, tmp_path):
    parts = [spark.sql("SELECT 1 AS id, 'a' AS s, named_struct('x', 1) AS n, array(1) AS l"),
             spark.sql("SELECT 3000000000 AS ID, 5 AS s, named_struct('x', 2Y, 'y', 'q') AS n"),
             spark.sql("SELECT 7 AS id, CAST(NULL AS string) AS s, CAST(NULL AS struct<x:int>) AS n, array(8L) AS l, 1.5BD AS more")]
    paths = [str(tmp_path / str(i)) for i in range(3)]
    for part, path in zip(parts, paths):
        part.write.parquet(path)
    got = read_evolving(spark, paths)
    assert got.schema.simpleString() == "struct<id:bigint,s:string,n:struct<x:int,y:string>,l:array<bigint>,more:decimal(2,1)>"
    rows = {r.id: (r.s, r.n and tuple(r.n), r.l, r.more and float(r.more)) for r in got.collect()}
    assert rows == {1: ("a", (1, None), [1], None), 3_000_000_000: ("5", (2, "q"), None, None), 7: (None, None, [8], 1.5)}
