"""URL rules by a sort-merge range join, with DataFrame operations only.

A reversed host (``org.example.``) turns "the host and its subdomains" into an interval of sorted keys, and a path
prefix is an interval of sorted paths. Both sides are sorted together and one sweep carries the innermost open interval
down to each URL. Two sweeps run: one over hosts, which gives the innermost rule host, and one over (rule host, path).
The stack of nested rules needs no state per row: each interval's start carries its own payload and its end that of the
enclosing interval, so the last boundary before a URL is the top of the stack. A sweep is split into key ranges; a range
takes over the last boundary of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.operators.materialize import materialize

# Rules of the registered query: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to / ? # or the end; then up to ? # or the end. Else both empty."""
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.substring(url, found + F.lit(3), F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_host(host: Column) -> Column:
    """``www.example.org`` as ``org.example.www.``: a host's subdomains share its reversed form as a prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _key(c: Column) -> Column:
    return c.cast("binary")


def _after(c: Column) -> Column:
    """Sorts behind every text that begins with ``c``: no UTF-8 text holds the byte FF."""
    return F.concat(c.cast("binary"), F.lit(b"\xff"))


def sweep(points: DataFrame, bounds: DataFrame, name: str) -> DataFrame:
    """Add ``top``, the payload of the last boundary at or before each point, to ``points``.

    points: key columns ``a``, ``b`` (binary), ``id`` (any order key that splits equal keys) and ``row`` (a struct);
    bounds: ``a``, ``b``, ``payload`` (a struct, null for "nothing open"). Ranges are cut by (a, b, kind, id), so equal
    keys spread over tasks; one row per range moves to carry the last boundary on.
    """
    kind = bounds.schema["payload"].dataType.simpleString()
    row = points.schema["row"].dataType.simpleString()
    both = bounds.select("a", "b", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("id"),
                         F.struct("payload").alias("mark"), F.lit(None).cast(row).alias("row")) \
        .unionByName(points.select("a", "b", F.lit(1).alias("kind"), F.col("id").cast("bigint").alias("id"),
                                   F.lit(None).cast(f"struct<payload:{kind}>").alias("mark"), "row"))
    ranged = materialize(both.repartitionByRange("a", "b", "kind", "id").withColumn("range", F.spark_partition_id()), name)
    last = ranged.where("kind = 0").groupBy("range").agg(F.max_by("mark", F.struct("a", "b")).alias("mark"))
    ranges = ranged.select("range").distinct().join(last, "range", "left")
    # One row per range: the window below runs over as many rows as there are tasks, not over data.
    carried = ranges.withColumn("carry", F.last("mark", ignorenulls=True).over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))).select("range", "carry")
    w = Window.partitionBy("range").orderBy("a", "b", "kind", "id").rowsBetween(Window.unboundedPreceding, 0)
    seen = ranged.withColumn("seen", F.last("mark", ignorenulls=True).over(w)).where("kind = 1")
    return seen.join(carried, "range").select(
        "row", F.coalesce(F.col("seen"), F.col("carry"))["payload"].alias("top"))


def host_bounds(rules: DataFrame) -> DataFrame:
    """Boundaries of the rule hosts' intervals; payload: the innermost rule host open there."""
    hosts = rules.select("host").distinct().withColumn("labels", F.split("host", r"\.", -1))
    # The enclosing rule host is the longest of a host's own parents that is a rule host too.
    parents = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size("labels"))),
                           lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))).alias("up"))
    outer = parents.join(hosts.select(F.col("host").alias("up")), "up").groupBy("host") \
        .agg(F.max_by("up", F.length("up")).alias("outer"))
    h = hosts.join(outer, "host", "left").withColumn("r", reversed_host(F.col("host")))
    empty = F.lit("").cast("binary")
    start = h.select(_key(F.col("r")).alias("a"), empty.alias("b"), F.struct("host").alias("payload"))
    end = h.select(_after(F.col("r")).alias("a"), empty.alias("b"),
                   F.when(F.col("outer").isNotNull(), F.struct(F.col("outer").alias("host"))).alias("payload"))
    return start.union(end)


def path_bounds(rules: DataFrame) -> DataFrame:
    """Boundaries over (rule host, path): a host's rules are its own and those of the rule hosts above it."""
    hosts = rules.select(F.col("host").alias("g")).distinct().withColumn("labels", F.split("g", r"\.", -1))
    ups = hosts.select("g", F.explode(F.transform(F.sequence(F.lit(1), F.size("labels")),
                       lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))).alias("host"))
    rule = F.struct(F.length(F.concat("host", "path")).alias("n"), F.length("host").alias("nh"),
                    F.concat("host", "path").alias("rule"), F.col("verdict"))
    own = ups.join(rules, "host").groupBy("g", "path").agg(F.max(rule).alias("best"))
    # Best rule among all prefixes of a rule's path, itself included (its stack), and excluded (the enclosing stack).
    prefixes = own.select("g", F.col("path").alias("of"), F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path")), lambda i: F.substring(F.col("path"), F.lit(1), i))).alias("path"))
    stack = prefixes.join(own, ["g", "path"]).groupBy("g", "of").agg(
        F.max("best").alias("inner"), F.max(F.when(F.col("path") != F.col("of"), F.col("best"))).alias("outer"))
    a = _key(F.col("g")).alias("a")
    start = stack.select(a, _key(F.col("of")).alias("b"), F.col("inner").alias("payload"))
    end = stack.select(a, _after(F.col("of")).alias("b"), F.col("outer").alias("payload"))
    clear = hosts.join(own.where("path = ''").select("g"), "g", "left_anti") \
        .select(a, _key(F.lit("")).alias("b"), F.lit(None).cast(own.schema["best"].dataType).alias("payload"))
    return start.union(end).union(clear)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per input row: ``key``, ``host``, ``path``, ``rule`` (host and path text, or null), ``verdict``.

    A rule fits its host and every subdomain if the URL's path begins with the rule's path. The longest rule text wins,
    ties go to the longer host, then to the larger text and verdict. No rule: ``default``. A null URL or one without
    ``://`` has empty host and path and the default. Repeated rows are judged each; null ids stay; no pages give no
    rows; no rules give the default everywhere; other columns are ignored. Repeated rules count once.
    """
    host, path = url_parts(F.col(url))
    p = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rules = rules.select("host", "path", "verdict").where("host IS NOT NULL AND path IS NOT NULL").distinct()
    points = p.select(_key(reversed_host(F.col("host"))).alias("a"), F.lit("").cast("binary").alias("b"),
                      F.xxhash64("key", "path").alias("id"), F.struct("key", "host", "path").alias("row"))
    hosted = sweep(points, host_bounds(rules), "url_hosts")
    points = hosted.select(_key(F.coalesce(F.col("top.host"), F.lit(""))).alias("a"), _key(F.col("row.path")).alias("b"),
                           F.xxhash64("row").alias("id"), "row")
    # Hosts under no rule host have the empty key, below every boundary.
    judged = sweep(points, path_bounds(rules), "url_paths")
    return judged.select(F.col("row.key").alias(key), F.col("row.host").alias("host"), F.col("row.path").alias("path"),
                         F.col("top.rule").alias("rule"), F.coalesce(F.col("top.verdict"), F.lit(default)).alias("verdict"))


def op7(pages: DataFrame) -> DataFrame:
    rules = pages.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
                                   + " AS t(host, path, verdict)")
    return judge_urls(pages, rules)


ORACLE = r"""
WITH rules(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS r FROM pages),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
         coalesce(translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM rest),
best AS (
  SELECT n, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(rverdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
"""
