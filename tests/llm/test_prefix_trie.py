"""Prefix trees against dictionaries of all prefixes."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos int, depth int, h1 string, row int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2, "h", 3) for r in rows], SCHEMA)


def brute(rows, shared):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if shared else 0
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    path, members = {}, collections.defaultdict(list)
    for c, v in whole.items():
        path[c] = [b""]
        for r, x in v:
            path[c].append(hashlib.md5(path[c][-1] + repr((r, x)).encode()).digest())
        for p in path[c]:
            members[p].append(c)
    at = {p: (min(m), path[min(m)].index(p)) for p, m in members.items()}
    kids = collections.Counter(path[c][d - 1] for c, d in at.values() if d)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, (c, d) in at.items():
        w = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", whole[c][d - 1][1])) if d else 0
        for up in path[c][:d + 1]:
            saved[up] += w
            leaves[up] += kids[p] == 0
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if path[c][-1] == p).encode()).hexdigest()
    return sorted((c, d, at[path[c][d - 1]][0] if d else None, len(members[p]), kids[p], leaves[p], saved[p], ends(p))
                  for p, (c, d) in at.items())


def same(got, rows, shared):
    assert sorted(map(tuple, got.collect())) == brute(rows, shared)


@pytest.mark.parametrize("per_range", [1_000_000, 40])
def test_random_conversations(spark, per_range):
    """Few different turns, so that much is shared; with 40 rows a range conversations span ranges."""
    rng = random.Random(per_range)
    rows = [(c, t, rng.choice("ua"), rng.choice(["yes", "no", "a b", " x\ty "])) for c in rng.sample(range(-60, 200), 120) for t in range(rng.randint(1, 9))]
    rows += [(7, t, "u", f"long {t % 3}") for t in range(130)] + [(27, t, "u", f"long {t % 3}") for t in range(128)]
    rng.shuffle(rows)
    same(prefix_trie.op13(frame(spark, rows), per_range), rows, True)
    same(prefix_trie.prefix_trie(frame(spark, rows), rows_per_range=per_range), rows, False)


def test_edges(spark):
    """Null and empty fields, null ids, turnless rebuilt conversations, repeated rows, equal turns, huge ids and texts."""
    big = (1 << 60) + 1
    rows = [(None, 0, "u", "lost"), (1, None, None, None), (1, 0, "u", ""), (1, 1, "", "u"), (big, 0, "u", "hi"), (-33, 0, "u", "hi"),
            (40, 0, "u", "w " * 200_000), (41, 0, "u", "w " * 200_000), (41, 1, "a", "x" * 2_000_000), (60, 0, "u", "same"), (61, 0, "u", "same"),
            (62, 0, "u", "same"), (62, 0, "u", "same"), (63, 3, "u", "same"), (63, 3, "u", "same"), *[(c, 0, "u", "only") for c in range(101, 112)]]
    same(prefix_trie.op13(frame(spark, rows)), rows, True)
    same(prefix_trie.prefix_trie(frame(spark, rows)), rows, False)
    assert prefix_trie.op13(frame(spark, [])).count() == 0
    assert prefix_trie.op13(frame(spark, [(None, 1, "u", "x")])).count() == 0


def test_long_conversations_cross_chunks_and_full_tries(spark, monkeypatch):
    """Conversations of more turns than a chunk; forks in the middle of a chunk."""
    rows = [(c, t, "u", f"t{t}" if t < 1010 + 9 * c else f"t{t} {c % 3}") for c in range(5) for t in range(1100 + c)]
    same(prefix_trie.prefix_trie(frame(spark, rows), rows_per_range=900), rows, False)


def test_trie_against_a_dictionary():
    """Exit nodes and counts of every insertion order, names standing for prefixes."""
    rng = random.Random(9)
    for _ in range(60):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 30))]
        trie, name = prefix_trie.ZFastTrie(), lambda p: (zlib.crc32(p.encode()) + 1, len(p))
        for i, s in enumerate(strings):
            trie.insert(prefix_trie.ROOT, 0, [name(s[:d]) for d in range(1, len(s) + 1)], list(range(1, len(s) + 1)), i)
            for node in trie.nodes:
                assert trie.handles[node.handle()] is node
        got = sorted(trie.expand())
        count, low = collections.Counter(), {}
        for i, s in enumerate(strings):
            for d in range(1, len(s) + 1):
                count[s[:d]] += 1
                low.setdefault(s[:d], i)
        assert got == sorted((*name(p), len(p), *(name(p[:-1]) if p[:-1] else prefix_trie.ROOT), n, low[p], len(p)) for p, n in count.items())


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 60):
            assert prefix_trie.two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda x: (x & -x))


def test_ends_of_a_large_group(spark):
    """Ids of one group over many ranges and pieces."""
    ids = list(range(5, 45_005))
    got = prefix_trie._ends(spark.createDataFrame([(1, 2, c) for c in ids] + [(3, 4, 9)], "k1 long, k2 long, conv long")).collect()
    assert {(r["k1"], r["k2"]): r["ends_sha256"] for r in got} == {
        (1, 2): hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), (3, 4): hashlib.sha256(b"9").hexdigest()}
