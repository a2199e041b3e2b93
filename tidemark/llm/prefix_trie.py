"""Prefix tree of conversations, built through Z-fast tries.

A prefix of a conversation is named by two sums of turn hashes, so a name costs one running sum, also across ranges of a
long conversation. Each task inserts the names of its conversations in batches into a Z-fast trie of bounded size: a
compacted trie whose nodes are found in a hash table by the name at their two-fattest depth. A fat binary search over
depths finds the node where a conversation leaves the trie. A full trie is expanded, edge by edge, into one row per
prefix with its counts, so what a third of all conversations share leaves a task as one row; Spark adds the rows up.

Sums over subtrees are taken on paths: a node belongs to its smallest member, so a conversation owns the lower end of its
own path, and each node's subtree is the sum, over owners passing through it, of what they own from there down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS
from tidemark.operators.materialize import materialize
from tidemark.operators.ntile import ROWS_PER_RANGE, SortKey, dealt_in_ranges

CHUNK = 1024            # turns of a conversation inserted as one string
SYMBOLS = 200_000       # names that a trie holds before it is expanded
PIECE = 10_000          # ids joined to one string before they are hashed
ROOT = (0, 0)
NODES = "k1 long, k2 long, depth long, q1 long, q2 long, n long, conv long, words long"
EMPTY = hashlib.sha256(b"").hexdigest()


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the highest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


@dataclass(eq=False)
class Node:
    """Compacted node: the edge above it covers the depths (top, top + len(path)]."""
    parent: Node | None
    top: int
    path: list[tuple[int, int]]        # names of the edge's prefixes
    words: list[int]                   # of each prefix's last turn
    children: dict = field(default_factory=dict)
    ends: int = 0
    least: int | None = None

    @property
    def extent(self) -> int:
        return self.top + len(self.path)

    def handle(self) -> tuple[int, int]:
        return self.path[two_fattest(self.top, self.extent) - self.top - 1]


class ZFastTrie:
    """Strings of names; a string starts below the prefix ``entry`` (the root, or where its conversation was cut)."""

    def __init__(self):
        self.entries: dict[tuple, Node] = {}
        self.handles: dict[tuple[int, int], Node] = {}
        self.nodes: list[Node] = []
        self.size = 0

    def exit_node(self, root: Node, x: list[tuple[int, int]]) -> Node:
        """Deepest node whose edge above ``x`` enters, by fat binary search over the handles."""
        node, low, high = root, root.extent, root.extent + len(x)
        while low < high:
            f = two_fattest(low, high)
            hit = self.handles.get(x[f - root.extent - 1])
            if hit is None:
                high = f - 1
            else:
                node, low = hit, hit.extent
        inside = node.extent - root.extent
        if node is root or inside < len(x) and x[inside - 1] == node.path[-1]:
            return node.children.get(x[inside], node) if inside < len(x) else node
        return node

    def insert(self, entry: tuple[int, int], depth: int, x: list[tuple[int, int]], words: list[int], conv: int) -> None:
        root = self.entries.get(entry)
        if root is None:
            root = self.entries[entry] = Node(None, depth, [], [])
        node = self.exit_node(root, x)
        at = node.top - depth                       # symbols of x above the node's edge
        same, most = 0, min(len(node.path), len(x) - at)
        while same < most and node.path[same] == x[at + same]:
            same += 1
        if same < len(node.path):
            node = self.split(node, same)
        if at + same < len(x):
            leaf = Node(node, node.extent, x[at + same:], words[at + same:])
            node.children[leaf.path[0]] = leaf
            self.add(leaf)
            self.size += len(leaf.path)
            node = leaf
        node.ends += 1
        node.least = conv if node.least is None else min(node.least, conv)

    def add(self, node: Node) -> None:
        self.nodes.append(node)
        self.handles[node.handle()] = node

    def split(self, node: Node, at: int) -> Node:
        """Cut a node's edge after ``at`` symbols; returns the new node between it and its parent."""
        del self.handles[node.handle()]
        upper = Node(node.parent, node.top, node.path[:at], node.words[:at], {node.path[at]: node})
        node.parent.children[upper.path[0]] = upper
        node.parent, node.top, node.path, node.words = upper, node.top + at, node.path[at:], node.words[at:]
        self.handles[node.handle()] = node
        self.add(upper)
        return upper

    def expand(self) -> Iterator[tuple]:
        """One row (schema ``NODES``) per prefix, with the number and the smallest id of the strings through it."""
        for node in sorted(self.nodes, key=lambda v: -v.extent):
            up = node.parent
            up.ends += node.ends
            up.least = node.least if up.least is None else min(up.least, node.least)
        entry = {id(root): name for name, root in self.entries.items()}
        for node in self.nodes:
            before = node.parent.path[-1] if node.parent.path else entry[id(node.parent)]
            for i, (name, words) in enumerate(zip(node.path, node.words)):
                yield *name, node.top + i + 1, *before, node.ends, node.least, words
                before = name


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _trie_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Expanded tries of rows sorted by (conv, depth)."""
    names, trie, rest = [f.split()[0] for f in NODES.split(", ")], ZFastTrie(), None

    def insert(c: list[np.ndarray], whole: bool) -> list[np.ndarray]:
        """Insert the runs of one conversation and chunk; without ``whole`` the last run may go on and comes back."""
        conv, depth, k1, k2, q1, q2, words = c
        chunk = (depth - 1) // CHUNK
        cut = np.flatnonzero((conv[1:] != conv[:-1]) | (chunk[1:] != chunk[:-1])) + 1
        edges = [0, *cut.tolist(), *[len(conv)] * whole]
        keys, words = list(zip(k1.tolist(), k2.tolist())), words.tolist()
        for lo, hi in zip(edges, edges[1:]):
            trie.insert((int(q1[lo]), int(q2[lo])), int(depth[lo]) - 1, keys[lo:hi], words[lo:hi], int(conv[lo]))
        return [x[edges[-1]:] for x in c]

    for b in batches:
        if not b.num_rows:
            continue
        c = [x.to_numpy() for x in b.columns]
        rest = insert(c if rest is None else [np.concatenate(x) for x in zip(rest, c)], False)
        if trie.size > SYMBOLS:
            yield _batch(list(trie.expand()), names)
            trie = ZFastTrie()
    if rest is not None:
        insert(rest, True)
    yield _batch(list(trie.expand()), names)


def _running(rows: DataFrame, sums: dict[str, Column], backwards: bool = False) -> DataFrame:
    """Running sums along each conversation, across the ranges it spans."""
    order = (lambda c: F.desc(c)) if backwards else F.asc
    inside = Window.partitionBy("_bucket", "conv").orderBy(order("pos")).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy(order("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_bucket", "conv").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    parts = parts.select("_bucket", "conv", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    out = rows.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()}).join(parts, ["_bucket", "conv"])
    return out.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop(*[f"_{n}" for n in sums])


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(conv, pos, h1, h2, words): turns of each conversation numbered from 0 by ``turn`` (null first; ties by content).

    ``h1`` and ``h2`` name role and text (null: empty). Rows without a conversation id are left out.
    """
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.xxhash64(r, t).alias("h1"),
        F.xxhash64(F.lit(1), t, r).alias("h2"), F.regexp_count(t, F.lit(f"[^{BLANKS}]+")).cast("long").alias("words"))
    rows = materialize(rows, "turns").withColumn("row", F.monotonically_increasing_id())   # parts repeated rows; files keep it
    dealt = dealt_in_ranges(rows, [SortKey(c) for c in ("conv", "turn", "h1", "h2", "row")], rows_per_bucket=rows_per_range)
    spans = dealt.groupBy("_bucket", "conv").agg(F.count("*").alias("n"), F.min("_place").alias("from"))
    before = Window.partitionBy("conv").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("_bucket", "conv", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("from")).alias("shift"))
    return dealt.join(spans, ["_bucket", "conv"]).select("conv", (F.col("_place") + F.col("shift")).alias("pos"), "h1", "h2", "words")


def _named(turns: DataFrame, rows_per_range: int) -> DataFrame:
    """(_bucket, conv, pos, depth, k1, k2, q1, q2, words): every prefix with its name ``k`` and the name ``q`` above it."""
    dealt = dealt_in_ranges(turns, [SortKey("conv"), SortKey("pos")], rows_per_bucket=rows_per_range)
    dealt = dealt.withColumns({"e1": F.xxhash64("pos", "h1", "h2").cast("decimal(20,0)"),
                               "e2": F.xxhash64(F.lit(1), "pos", "h2", "h1").cast("decimal(20,0)")})
    sums = _running(dealt, {"s1": F.col("e1"), "s2": F.col("e2")})
    name = lambda c: F.pmod(c, F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("long")
    return materialize(sums.select("_bucket", "conv", "pos", (F.col("pos") + 1).alias("depth"), name(F.col("s1")).alias("k1"),
                                   name(F.col("s2")).alias("k2"), name(F.col("s1") - F.col("e1")).alias("q1"),
                                   name(F.col("s2") - F.col("e2")).alias("q2"), "words"), "prefixes")


def _ends(last: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of rows (k1, k2, conv): ids joined in ascending order, piece by piece, and hashed as a stream."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2, conv = (x.to_numpy() for x in b.columns)
            if not len(conv):
                continue
            cut = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            edges = [c for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(conv)]) for c in range(lo, hi, PIECE)]
            ids = [",".join(map(str, conv[lo:hi].tolist())) for lo, hi in zip(edges, [*edges[1:], len(conv)])]
            yield pa.RecordBatch.from_arrays([pa.array(k1[edges]), pa.array(k2[edges]), pa.array(conv[edges]), pa.array(ids)],
                                             ["k1", "k2", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for b in batches:
            for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == key:
                    state.update(b"," + ids.encode())
                else:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "ends_sha256"), d)) for d in done], schema)
            done = []
        if key:
            yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "ends_sha256"), (*key, state.hexdigest())))], schema)

    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    order = ["k1", "k2", "conv"]
    parts = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "k1 long, k2 long, first long, ids string")
    return parts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(hashed, "k1 long, k2 long, ends_sha256 string")


def prefix_nodes(turns: DataFrame, members: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (:func:`numbered_turns`), the root included.

    ``members`` (conv): all conversations, also those without turns. Columns: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Without members no
    rows, not even the root.
    """
    path = _named(turns, rows_per_range)
    strings = path.select("conv", "depth", "k1", "k2", "q1", "q2", "words") \
        .repartition("conv", F.floor((F.col("depth") - 1) / CHUNK)).sortWithinPartitions("conv", "depth")
    found = strings.mapInArrow(_trie_rows, NODES).groupBy("k1", "k2").agg(
        F.min("depth").alias("depth"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.sum("n").alias("n"),
        F.min("conv").alias("conv"), F.max("words").alias("words"))
    zero = F.lit(0).cast("long")
    root = members.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).where("n > 0").select(
        *[zero.alias(c) for c in ("k1", "k2", "depth")], *[F.lit(None).cast("long").alias(c) for c in ("q1", "q2")],
        "n", "conv", zero.alias("words"))
    found = materialize(found.unionByName(root), "nodes")

    # Written tables on both sides: Spark splits the children of a hot parent.
    counts = materialize(found.where("depth > 0").groupBy("q1", "q2").agg(F.count("*").alias("n_children"))
                         .withColumnsRenamed({"q1": "k1", "q2": "k2"}), "children")
    above = found.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv").alias("parent_conv_id"))
    nodes = found.join(above, ["q1", "q2"], "left").join(counts, ["k1", "k2"], "left") \
        .select("k1", "k2", "depth", "n", "conv", "parent_conv_id", F.coalesce("n_children", zero).alias("n_children"),
                ((F.col("n") - 1) * F.col("words")).alias("saved"))
    nodes = materialize(nodes, "counted_nodes")

    own = nodes.select("conv", "depth", "saved", (F.col("n_children") == 0).cast("long").alias("leaf"))
    owners = own.select("conv").distinct()
    held = path.select("_bucket", "conv", "pos", "depth", "k1", "k2").join(owners, "conv", "left_semi") \
        .join(own, ["conv", "depth"], "left").fillna(0, ["saved", "leaf"])
    below = _running(held, {"saved_tokens": F.col("saved"), "n_leaves": F.col("leaf")}, backwards=True)
    total = own.agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves")).where("n_leaves > 0")
    sums = below.groupBy("k1", "k2").agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves")) \
        .unionByName(total.select(zero.alias("k1"), zero.alias("k2"), "saved_tokens", "n_leaves"))

    last = path.groupBy("conv").agg(F.max_by(F.struct("k1", "k2"), "depth").alias("k"))
    last = members.join(last, "conv", "left").select(F.coalesce("k.k1", zero).alias("k1"), F.coalesce("k.k2", zero).alias("k2"), "conv")
    return nodes.join(sums, ["k1", "k2"]).join(_ends(materialize(last, "ends")), ["k1", "k2"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Prefix tree (:func:`prefix_nodes`) of conversations as they are.

    Null turns come first; rows with the same turn follow by a hash of their content, and repeated rows are turns each.
    Null role or text is empty; a null id is no conversation; an empty table gives no rows; other columns are ignored.
    """
    turns = materialize(numbered_turns(conversations, conv, turn, role, text, rows_per_range), "numbered")
    return prefix_nodes(turns, turns.select("conv").distinct(), rows_per_range)


def shared_heads(turns: DataFrame, family: int = 20, most: int = 3) -> DataFrame:
    """Turns with shared first turns: conversation c takes the first h turns of c - c % ``family`` (fewer, if it has fewer;
    none, if absent), then its own turns after its first h; h = crc32(decimal c) % (``most`` + 1).
    """
    head = turns.where((F.col("conv") % family == 0) & (F.col("pos") < most)).groupBy(F.col("conv").alias("base")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "words"))).alias("head"))   # at most ``most`` turns each
    h = (F.crc32(F.col("conv").cast("string")) % (most + 1)).cast("int")
    taken = turns.where("pos = 0").select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base")) \
        .join(head, "base", "left").select("conv", "h", F.slice(F.coalesce("head", F.array().cast(head.schema["head"].dataType)), F.lit(1), F.col("h")).alias("head"))
    taken = materialize(taken, "heads")
    own = turns.join(taken.select("conv", "h", F.size("head").alias("g")), "conv").where("pos >= h") \
        .select("conv", (F.col("pos") - F.col("h") + F.col("g")).alias("pos"), "h1", "h2", "words")
    return own.unionByName(taken.select("conv", F.explode("head").alias("t")).select("conv", "t.pos", "t.h1", "t.h2", "t.words"))


def op13(conversations: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    turns = materialize(numbered_turns(conversations, rows_per_range=rows_per_range), "numbered")
    rebuilt = materialize(shared_heads(turns), "rebuilt")
    return prefix_nodes(rebuilt, turns.where("pos = 0").select("conv"), rows_per_range)


ORACLE = r"""
WITH numbered AS (
  SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv, conv - conv % 20 AS base, count(*) AS own FROM numbered GROUP BY conv),
hashed AS (
  SELECT conv, base, (4294967295 - list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 4 AS h
  FROM convs),
heads AS (SELECT c.conv, c.h, least(c.h, coalesce(b.own, 0)) AS g, c.base FROM hashed c LEFT JOIN convs b ON b.conv = c.base),
rebuilt AS (
  SELECT n.conv, n.pos - c.h + c.g + 1 AS depth, n.role, n.text FROM numbered n JOIN heads c ON c.conv = n.conv WHERE n.pos >= c.h
  UNION ALL
  SELECT c.conv, n.pos + 1, n.role, n.text FROM heads c JOIN numbered n ON n.conv = c.base WHERE n.pos < c.h),
paths AS (
  SELECT conv, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         string_agg(sha256(length(role)::VARCHAR || ':' || role || text), '') OVER (PARTITION BY conv ORDER BY depth) AS path
  FROM rebuilt
  UNION ALL SELECT conv, 0, 0, '' FROM convs),
nodes AS (SELECT depth, path, min(conv) AS conv, count(*) AS n, any_value(words) AS words FROM paths GROUP BY depth, path),
children AS (
  SELECT a.depth, a.path, count(b.path) AS n_children
  FROM nodes a LEFT JOIN nodes b ON b.depth = a.depth + 1 AND b.path[1:64 * a.depth] = a.path GROUP BY a.depth, a.path),
weighed AS (SELECT n.*, c.n_children FROM nodes n JOIN children c ON c.depth = n.depth AND c.path = n.path),
below AS (
  SELECT p.depth, p.path, sum((n.n - 1) * n.words) AS saved, sum((n.n_children = 0)::INT) AS leaves
  FROM weighed n JOIN paths p ON p.conv = n.conv AND p.depth <= n.depth GROUP BY p.depth, p.path),
ends AS (
  SELECT path, string_agg(conv::VARCHAR, ',' ORDER BY conv) AS ids
  FROM (SELECT conv, max(path) AS path FROM paths GROUP BY conv) GROUP BY path)
SELECT n.conv AS conv_id, n.depth::BIGINT AS depth, up.conv AS parent_conv_id, n.n AS n_convs, n.n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM weighed n JOIN below b ON b.depth = n.depth AND b.path = n.path
LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.path = n.path[1:64 * (n.depth - 1)]
LEFT JOIN ends e ON e.path = n.path
"""
