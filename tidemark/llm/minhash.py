"""Near-duplicate detection by b-bit MinHash, confirmed on the full shingle sets.

1. One Arrow pass hashes each text's 5-word shingles and keeps ``BANDS * ROWS`` minima: their low ``BITS`` bits packed
   into a signature, and one key per band. Documents with equal sets are one class from here on (smallest id).
2. Classes that share a band key are candidates. A bucket is never expanded into pairs: first each class meets only the
   best-estimated hub (smallest id) of its buckets, and confirmed links form components.
3. Buckets whose classes still lie in different components are cut into blocks of bounded bytes. A task holds two
   blocks: signatures are compared by bit counts, each pair only in the first band it shares, and what may reach the
   threshold is confirmed on the full sets there. A task emits at most a spanning forest of the components it joins.

A pair at a similarity of 0.75 shares no band with probability (1 - 0.75**5)**48 = 2.3e-6, and the estimate misses it
beyond six standard deviations. Hot groups: copies collapse by a partial minimum, hub rows are linear in the bucket,
blocks bound what a task holds, and components come from star contraction over links, never on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import groups
from tidemark.llm.components import components
from tidemark.llm.textnum import U64, mix, shingle_set
from tidemark.operators.materialize import materialize

ROWS, BANDS, BITS = 5, 48, 4
MINIMA = ROWS * BANDS
FACTOR = np.random.default_rng(1999).integers(1, 1 << 63, MINIMA, dtype=U64) * U64(2) + U64(1)
PLACE = np.random.default_rng(2001).integers(1, 1 << 63, ROWS, dtype=U64) * U64(2) + U64(1)
BLOCK = 1024             # classes of a bucket per block, if their sets are small: fewer blocks, fewer copies of a class
BLOCK_SHINGLES = 500_000 # shingles of a bucket per block (4 MB)
CONFIRM = 32             # candidates of one class confirmed at once
CHUNK = 2048             # shingles hashed at once
NIBBLES = U64(0x1111111111111111)


def minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(MINIMA, np.iinfo(U64).max, U64)
    for at in range(0, len(shingles), CHUNK):
        np.minimum(out, (FACTOR[:, None] * shingles[None, at:at + CHUNK]).min(axis=1), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    return mix((m.reshape(BANDS, ROWS) * PLACE).sum(axis=1, dtype=U64) + np.arange(1, BANDS + 1, dtype=U64)).view(np.int64)


def pack_bits(m: np.ndarray) -> bytes:
    """The low ``BITS`` bits of the minima, 16 to a word."""
    low = (m & U64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return np.bitwise_or.reduce(low << np.arange(0, 64, BITS, dtype=U64), axis=1).tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures (last axis: words): equal minima by bit count, corrected for chance equality."""
    x = a ^ b
    x |= x >> U64(2)
    x |= x >> U64(1)
    differ = np.bitwise_count(x & NIBBLES).sum(axis=-1)
    chance = 1 / (1 << BITS)
    return ((1 - differ / MINIMA) - chance) / (1 - chance)


def floor_for(similarity: float) -> float:
    """Lowest estimate that a pair of this similarity shows, within six standard deviations."""
    chance = 1 / (1 << BITS)
    equal = chance + (1 - chance) * similarity
    return similarity - 6 * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - chance)


def _words(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), U64).reshape(len(column), MINIMA * BITS // 64)


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()


def sketch(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(k, n, cls, bands, sig) per row; ``cls`` names the shingle set. Ids pass through Arrow untouched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, cls, bands, sig = [], [], [], []
            for t in b.column("t"):
                s = shingle_set(t.as_py(), shingle)
                m = minima(s) if len(s) else None
                n.append(len(s))
                cls.append(set_name(s) if len(s) else None)
                bands.append(band_keys(m) if len(s) else None)
                sig.append(pack_bits(m) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                                              pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                                             ["k", "n", "cls", "bands", "sig"])

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")) \
        .mapInArrow(run, "k long, n long, cls binary, bands array<long>, sig binary")


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(id, s): the shingle set of every class in ``wanted`` (id, cls, rep), from a row of its representative."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([pa.array([set_name(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "s"])

    rows = docs.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("t"))
    made = rows.join(wanted.select("rep").distinct().hint("shuffle_hash"), "rep", "left_semi").mapInArrow(run, "cls binary, s binary")
    return made.join(wanted.select("id", "cls"), "cls").select("id", "s").dropDuplicates(["id"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
            same = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * same >= percent * (len(x) + len(y) - same))
        return pd.Series(out, dtype=bool)

    p = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return p.where(linked("sa", "sb")).select("a", "b")


def _common(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted ``x`` with each of ``others``."""
    every = np.concatenate(others)
    hit = x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every
    return np.add.reduceat(hit, np.r_[0, np.cumsum([len(o) for o in others])[:-1]], dtype=np.int64)


def _group_links(pdf: pd.DataFrame, floor: float, percent: int) -> list[tuple[int, int]]:
    """Links between components of one group (key, i, j), as pairs of component ids."""
    root, blk = pdf["comp"].to_numpy().copy(), pdf["blk"].to_numpy()
    sig, bands = _words(pdf["sig"]), np.stack(pdf["bands"].to_numpy())
    sets = [np.frombuffer(s, U64) for s in pdf["s"]]
    size = np.array([len(s) for s in sets])
    band = int((bands[0] == pdf["key"].iloc[0]).argmax())
    across, found = pdf["i"].iloc[0] != pdf["j"].iloc[0], []
    for x in range(len(root) - 1):
        fits = (root[x + 1:] != root[x]) & (100 * np.minimum(size[x + 1:], size[x]) >= percent * np.maximum(size[x + 1:], size[x]))
        if across:   # within a block is the work of the group (key, i, i)
            fits &= blk[x + 1:] != blk[x]
        other = np.flatnonzero(fits) + x + 1
        other = other[(bands[other] == bands[x]).argmax(axis=1) == band] if len(other) else other
        if not len(other):
            continue
        e = estimate(sig[other], sig[x])
        other = other[np.argsort(-e, kind="stable")][:int((e >= floor).sum())]
        while len(other):
            some, other = other[:CONFIRM], other[CONFIRM:]
            same = _common(sets[x], [sets[y] for y in some])
            for y in some[100 * same >= percent * (size[x] + size[some] - same)]:
                if root[y] != root[x]:
                    found.append((int(root[x]), int(root[y])))
                    root[root == root[y]] = root[x]
            other = other[root[other] != root[x]]
    return found


def _block_links(rows: DataFrame, floor: float, percent: int) -> DataFrame:
    """Links (a, b) between components, found within the groups (key, i, j)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []
        for group in groups(batches, ["key", "i", "j"]):
            found += _group_links(group, floor, percent)
            if len(found) > 10_000:
                yield pd.DataFrame(found, columns=["a", "b"])
                found = []
        yield pd.DataFrame(found, columns=["a", "b"])

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 75) -> DataFrame:
    """One row per input row: ``key``, ``n_shingles``, ``component_id``, ``kept``.

    Null, empty and wordless texts have no shingles and link with nothing (component: the own id). Repeated rows get
    equal results; rows that share an id but not the text are judged each by its own text. A null id never represents
    a component: a class of null ids only has a null component and is kept. Ties do not arise: components and
    representatives are minima. An empty table gives no rows; other columns are ignored.
    """
    floor = floor_for(percent / 100)
    s = materialize(sketch(docs, key, text, shingle), "sketch")
    # Classes, not ids, are linked. Their numbers follow the order of their smallest ids, so the smallest number of a component
    # names its smallest id. Written, so that the numbers stay and the joins below meet two plain exchanges, of which Spark
    # can split a class of very many copies.
    reps = materialize(s.where("cls IS NOT NULL AND k IS NOT NULL").groupBy("cls").agg(F.min("k").alias("rep")), "class_reps")
    reps = materialize(reps.repartitionByRange("rep", "cls").sortWithinPartitions("rep", "cls")
                       .withColumn("id", F.monotonically_increasing_id()), "reps")
    own = s.where("k IS NOT NULL").select("cls", F.col("k").alias("rep"), "n", "bands", "sig")
    classes = materialize(own.join(reps, ["cls", "rep"]).dropDuplicates(["id"]).select("id", "n", "bands", "sig"), "classes")
    sig = classes.select("id", "sig")

    banded = classes.select("id", "n", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    buckets = materialize(banded.join(shared.select("key", "hub"), "key"), "buckets")
    wanted = reps.join(buckets.select("id").distinct(), "id", "left_semi")
    sets = materialize(_sets(docs, wanted, key, text, shingle), "sets")

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(estimate(_words(a), _words(b)))

    hubs = buckets.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct() \
        .join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a") \
        .join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b") \
        .select("a", "b", alike("sa", "sb").alias("e")).where(F.col("e") >= floor)
    nearest = hubs.groupBy("b").agg(F.max_by("a", F.struct("e", -F.col("a"))).alias("a")).select("a", "b")
    labels = components(_confirmed(nearest, sets, percent))

    comp = F.coalesce("comp", "id").alias("comp")
    placed = buckets.join(labels, "id", "left").select("key", "id", comp, "n")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), blocks.alias("blocks")) \
        .where("c1 < c2").select("key", "blocks")
    dealt = placed.join(mixed, "key").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")) \
        .select("key", "id", "comp", "blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")) \
        .select("key", "id", "comp", "blk", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"))
    held = classes.select("id", "sig", "bands").join(sets, "id")
    links = _block_links(dealt.join(held, "id"), floor, percent)
    # Components of this smaller graph over components complete the labels.
    more = materialize(components(links), "more")
    up = more.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
    moved = labels.join(up, "comp", "left").select("id", F.coalesce("up", "comp").alias("comp"))
    # A component's own smallest id has no label yet; it gets one when its component moves.
    labels = moved.union(more)

    first = reps.select(F.col("id").alias("comp"), F.col("rep").alias("least"))
    named = materialize(labels.join(first, "comp").select("id", "least"), "component_reps")
    named = materialize(reps.join(named, "id", "left").select("cls", F.coalesce("least", "rep").alias("least")), "component_of")

    rows = s.select("k", "n", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("k")).otherwise(F.col("least"))
    return rows.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")) \
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def op3(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
