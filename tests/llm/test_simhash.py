"""SimHash against brute force: fingerprints from their definition, links from all pairs of a small table."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash

SCHEMA = "doc_id long, text string, id string, f int, comp string, key int, t double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "c", 2, 0.5) for i, t in rows], SCHEMA)


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least(names, links):
    """Component of each name as its smallest member."""
    root = {n: n for n in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in names}


def brute(rows, within=2):
    prints = [plain(t) for _, t in rows]
    pairs = [(a, b) for i, a in enumerate(set(prints)) for b in list(set(prints))[i + 1:] if (a ^ b).bit_count() <= within]
    comp = least(set(prints), pairs)
    ids = {}
    for (i, _), f in zip(rows, prints):
        if i is not None:
            ids[comp[f]] = min(i, ids.get(comp[f], i))
    return sorted(((i, format(f, "016x"), ids.get(comp[f])) for (i, _), f in zip(rows, prints)), key=str)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, simhash.op12(docs).collect()), key=str) == brute(rows)


def test_edges(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [(None, "no id here but some words"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, long), (6, long.upper()), (5, "twice the same"),
            (5, "twice the same"), (5, "another text of that id"), ((1 << 60) + 1, "Ünïcode WORDS stay é"), (8, "one"), (9, "one\x1ctwo"), (10, "x" * 3_000_000)]
    assert sorted(map(tuple, simhash.op12(frame(spark, rows)).collect()), key=str) == brute(rows)
    assert simhash.op12(frame(spark, [])).count() == 0


def test_windows_do_not_change_a_fingerprint(monkeypatch):
    from tidemark.llm import textnum
    text = "\n".join("Some words of Line %d\t here é  and there" % i for i in range(300)) + " " + "y" * 500 + " end of it"
    want = plain(text)
    assert simhash.fingerprint(text.encode()) == want
    monkeypatch.setattr(textnum, "WINDOW", 64)
    assert simhash.fingerprint(text.encode()) == want


def planted(rng, n):
    """Fingerprints with planted neighbours at 0 to 4 bits, on every place of the ring, and a dense ball."""
    out = {rng.getrandbits(64) for _ in range(n)}
    for f in list(out):
        for bits in range(1, 5):
            g = f
            for b in rng.sample(range(64), bits):
                g ^= 1 << b
            out.add(g)
    centre = rng.getrandbits(64)
    out |= {centre ^ sum(1 << b for b in rng.sample(range(6), rng.randint(0, 6))) for _ in range(200)}
    out |= {0, 1, 3, (1 << 63), (1 << 64) - 1, (1 << 64) - 2}
    return sorted(out)


@pytest.mark.parametrize("within,bucket", [(2, 64), (2, 1), (1, 64), (1, 1)])
def test_links_against_all_pairs(spark, monkeypatch, within, bucket):
    """With ``bucket`` 1 every shared bucket is hot, so the centres do all the work."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    prints = planted(random.Random(within), 120)
    f = np.array(prints, np.uint64).view(np.int64).tolist()
    got = simhash.links(spark.createDataFrame([(x,) for x in f], "f long"), within).collect()
    u = np.array(prints, np.uint64)
    pairs = [(f[i], f[j]) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u[i] ^ u) <= within) if i < j]
    true = {frozenset(p) for p in pairs}
    assert {frozenset(r) for r in got} <= true
    if bucket > 1:      # no bucket is hot but the ball's
        ball = {p for p in true if sum(len(p & q) > 0 for q in true) < 20}
        assert ball <= {frozenset(r) for r in got}
    assert least(f, [tuple(r) for r in got]) == least(f, pairs)


def test_chain_filter_keeps_every_pair_within_its_distance():
    rng = random.Random(4)
    for within in (1, 2):
        differ = [sum(1 << b for b in rng.sample(range(64), rng.randint(0, within))) for _ in range(2000)]
        d = np.array(differ, np.uint64)
        size = simhash.equal_segments(within) * simhash.WIDTH
        seen = np.zeros(len(d), bool)
        for start in range(simhash.SEGMENTS):
            s = np.full(len(d), start)
            turned = np.array([((x >> start * 4) | (x << (64 - start * 4))) & ((1 << size) - 1) for x in differ], object) == 0
            seen |= turned & simhash.chain_filter(d, s, within)
        assert seen.all()


def test_distance_zero_and_bad_distance(spark):
    rows = [(2, "a b c d"), (1, "A b C d"), (3, "a b c e")]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame(spark, rows), within=0).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    with pytest.raises(ValueError):
        simhash.near_duplicates(frame(spark, rows), within=3)
