"""SimHash near-duplicates by pigeonring filtering of 64-bit fingerprints.

A fingerprint is a ring of ``SEGMENTS`` segments. Two fingerprints that differ in at most ``within`` bits have a segment
from which every chain of consecutive segments keeps its differences within the chain's proportional share of the budget
(cycle lemma). The leading chain whose share is below one bit must be equal: its bits and its place on the ring are the
bucket key. Inside a bucket the budgets of the longer chains prune the pairs before the full Hamming distance.

Equal fingerprints are one class from the start. A bucket with more than ``BUCKET`` classes is not compared pair by
pair: each of its classes goes to the 65 centres at most one bit away. Two fingerprints differ in at most two bits just
when they share a centre, and no centre has more than 65 of them, so hot buckets cost 65 small rows a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.textnum import LOWER, U64, windows
from tidemark.operators.materialize import materialize

SEED = 42
SEGMENTS, WIDTH = 16, 4      # of a fingerprint: segments, and bits of each
BUCKET = 64                  # classes of a bucket that are compared with each other


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text: bit set if more than half of the shingles' XXH64 values have it; no words give 0."""
    counts, n, rest = np.zeros(64, np.int64), 0, []

    def add(hashes: list[int]) -> None:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add(counts, bits.sum(axis=0, dtype=np.int64), out=counts)

    for piece, one_word in windows(raw.translate(LOWER)):
        words = rest + ([piece] if one_word else piece.split())
        rest = words[len(words) - shingle + 1:] if len(words) >= shingle else words
        if len(words) >= shingle:
            joined = b" ".join(words)
            end = np.cumsum([len(w) + 1 for w in words])
            start = np.r_[0, end[:-1]]
            many = len(words) - shingle + 1
            add([xxhash.xxh64_intdigest(joined[s:e], SEED)
                 for s, e in zip(start[:many].tolist(), (end[shingle - 1:] - 1).tolist())])
            n += many
    if not n and rest:
        add([xxhash.xxh64_intdigest(b" ".join(rest), SEED)])
        n = 1
    return sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, f): a fingerprint per row, as the signed long of its 64 bits; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.array(f, U64).view(np.int64))], ["id", "f"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).mapInArrow(run, "id long, f long")


def budgets(within: int) -> list[int]:
    """Whole bits that a chain of 1, 2, ... segments may differ in: its proportional share of ``within``."""
    return [length * within // SEGMENTS for length in range(1, SEGMENTS + 1)]


def equal_segments(within: int) -> int:
    """Length of the leading chain whose share is below one bit; its bits and its start fit into a long."""
    return min(sum(b == 0 for b in budgets(within)), 56 // WIDTH)


def ring_keys(f: Column, within: int) -> Column:
    """For each segment as the start: its number and the bits of the chain that must be equal."""
    size = equal_segments(within) * WIDTH
    low = F.lit((1 << size) - 1)

    def turned(bits: int) -> Column:
        return f if not bits else F.shiftrightunsigned(f, bits).bitwiseOR(F.shiftleft(f, 64 - bits))

    return F.array(*[F.lit(i << size).bitwiseOR(turned(i * WIDTH).bitwiseAND(low)) for i in range(SEGMENTS)])


def chain_filter(differ: np.ndarray, start: np.ndarray, within: int) -> np.ndarray:
    """Whether all chains from segment ``start`` keep the differing bits within their budgets."""
    turn = (start * WIDTH).astype(U64)
    ring = (differ >> turn) | (differ << ((U64(64) - turn) & U64(63)))
    fits, share = np.ones(len(differ), bool), budgets(within)
    for length in range(1, SEGMENTS):
        if share[length] != share[length - 1]:   # the longest chain of each share implies the shorter ones
            fits &= np.bitwise_count(ring & U64((1 << length * WIDTH) - 1)) <= share[length - 1]
    return fits


def bucket_links(key: np.ndarray, f: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs among rows sorted by ``key``: every pair of a run of equal keys is looked at, lag by lag."""
    u, size, left, right = f.view(U64), equal_segments(within) * WIDTH, [], []
    for lag in range(1, len(key)):
        at = np.flatnonzero(key[lag:] == key[:-lag])
        if not len(at):
            break
        differ = u[at] ^ u[at + lag]
        at, differ = at[fits := chain_filter(differ, key[at] >> size, within)], differ[fits]
        at = at[np.bitwise_count(differ) <= within]
        left.append(f[at]), right.append(f[at + lag])
    return np.concatenate([f[:0], *left]), np.concatenate([f[:0], *right])


def _ring_links(rows: DataFrame, within: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, f = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:
            key = np.concatenate([key, b.column("key").to_numpy()])
            f = np.concatenate([f, b.column("f").to_numpy()])
            if not len(key):
                continue
            whole = int(np.searchsorted(key, key[-1]))    # the last run may go on in the next batch
            yield pa.RecordBatch.from_arrays([*map(pa.array, bucket_links(key[:whole], f[:whole], within))], ["a", "b"])
            key, f = key[whole:], f[whole:]
        yield pa.RecordBatch.from_arrays([*map(pa.array, bucket_links(key, f, within))], ["a", "b"])

    return rows.repartition("key").sortWithinPartitions("key", "f").mapInArrow(run, "a long, b long")


def _centre_links(f: DataFrame, within: int) -> DataFrame:
    """Links of distinct fingerprints through centres at most one bit away from each (at most 65 to a centre)."""
    near = F.array(F.col("f"), *[F.col("f").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)])
    met = f.select("f", F.explode(near).alias("centre")).groupBy("centre").agg(F.collect_list("f").alias("m")).where("size(m) > 1")
    if within == 1:     # only a centre that is a fingerprint itself is one bit away from the others
        met = met.where(F.array_contains("m", F.col("centre")))
    hub = F.col("centre") if within == 1 else F.array_min("m")
    return met.select(hub.alias("a"), F.explode("m").alias("b")).where("a != b")


def links(classes: DataFrame, within: int = 2) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``f``; in hot buckets, links that join the same components."""
    keyed = classes.select("f", F.explode(ring_keys(F.col("f"), within)).alias("key"))
    sizes = materialize(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "ring_sizes")
    met = materialize(keyed.join(sizes, "key").select("key", "f", (F.col("n") > BUCKET).alias("hot")), "ring")
    near = _ring_links(met.where("NOT hot").select("key", "f"), within)
    return near.unionByName(_centre_links(met.where("hot").select("f").distinct(), within))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, within: int = 2) -> DataFrame:
    """One row per input row: ``key``, ``fingerprint`` (16 lowercase hex digits), ``component_id`` (smallest id reachable).

    ``within`` (0, 1 or 2): differing bits of a link. Null, empty and wordless texts have fingerprint zero and link like
    any other. A row is judged by its own text: repeated rows get equal results, and rows that share an id but not the
    text may lie in different components. Null ids take part but never name a component; where all are null, it is
    null. Ties do not arise (all choices are minima); an empty table gives no rows; other columns are ignored.
    """
    if within not in (0, 1, 2):
        raise ValueError("within must be 0, 1 or 2")
    rows = materialize(fingerprints(docs, key, text, shingle), "fingerprints")
    classes = materialize(rows.groupBy("f").agg(F.min("id").alias("rep")), "classes")
    if within:
        labels = materialize(components(links(classes.select("f"), within), "simhash_cc"), "labels")
        named = classes.join(labels, classes["f"] == labels["id"], "left").select("f", "rep", F.coalesce("comp", "f").alias("comp"))
        named = materialize(named, "named")
        smallest = materialize(named.groupBy("comp").agg(F.min("rep").alias("component_id")), "smallest")
        named = materialize(named.join(smallest, "comp").select("f", "component_id"), "component_of")
    else:
        named = classes.withColumnRenamed("rep", "component_id")
    return rows.join(named, "f").select(F.col("id").alias(key), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def op12(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
