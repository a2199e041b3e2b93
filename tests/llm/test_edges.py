"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import math
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (bm25, language_id, line_dedup, minhash, mixing, packing, quality, secrets, simhash,
                          url_filter, vector_search)

SCHEMA = "doc_id long, text string, lang string, source string, score double, sequence_id long, line string, h long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
SAME = "the same line that is long enough to be counted as one of many"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, l, "s", 1.0, 1, "x", 1) for i, t, l in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None, "no id here but some words in it", "en"), (1, None, None), (2, "", "en"), (3, " \n\t ", "de"), (4, LONG, "en"),
            (5, "twice the same row of five words", "de"), (5, "twice the same row of five words", "de"), (6, "1234 !!! ...", "en")]
    rows += [(10 + i, f"{SAME}\nown line {i} is here and it is long enough to count too {i}", "en") for i in range(6)]
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, []).cache()


def test_packing(spark, odd, empty):
    got = packing.op1(odd).toPandas()
    docs = odd.toPandas()
    assert got["length"].sum() == sum(len(ids(t)) + 1 for t in docs["text"])
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert list(seq["offset"]) == list(np.r_[0, seq["length"].cumsum()[:-1]]) and seq["length"].sum() <= 1024
    long = got[got["doc_id"] == 4].sort_values("start")
    assert list(long["start"]) == list(np.r_[0, long["length"].cumsum()[:-1]])
    all_ids = np.array(ids(LONG) + [0], "<u4")
    for r in long.itertuples():
        assert r.ids_crc32 == zlib.crc32(all_ids[r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(all_ids)
    assert packing.op1(empty).count() == 0


def ids(text):
    from tokenizers import Tokenizer
    import public_tokenizers as p
    t = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text if isinstance(text, str) else "", add_special_tokens=False).ids


def test_packing_ids_equal_the_tokenizer():
    enc = packing._encoder(packing.ranks_path())
    for t in ["a  b   c \n d", " \n y\x1c z!", "<|endoftext|> hi", "é ñ ß 😀 don't", "tail \n", "  x"]:
        assert enc.encode_ordinary(t) == ids(t)


def test_packing_special_token_is_one_id(spark):
    from tokenizers import Tokenizer
    import public_tokenizers as p
    t = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    enc, end = packing._encoder(packing.ranks_path()), "<|endoftext|>"
    texts = [end, f"a {end} b", f"{end}{end}x", f"tail  {end}", f"don't{end}<|endof{end}text|>", end[1:], " " * 150_000 + end + "\n" * 150_000]
    for x in texts:
        assert packing.encode(enc, x) == t.encode(x, add_special_tokens=False).ids
    got = packing.op1(frame(spark, [(1, end, "en")])).collect()
    want = np.array([50256, 0], "<u4")
    assert [(r["length"], r["doc_tokens"], r["ids_crc32"]) for r in got] == [(2, 2, zlib.crc32(want.tobytes()))]


def test_packing_long_blank_runs(spark, monkeypatch):
    n = 2_000_000
    rows = [(1, " " * n, "en"), (2, "a b" + "\n" * n + "tail", "en"), (3, " \t" * (n // 2) + " x " + "\u3000" * 150_000 + "y", "en"),
            (4, "after", "en")]
    got = packing.op1(frame(spark, rows)).toPandas()
    for i, t, _ in rows:
        all_ids = np.array(ids(t) + [0], "<u4")
        own = got[got["doc_id"] == i].sort_values("start")
        assert own["length"].sum() == len(all_ids) and (own["doc_tokens"] == len(all_ids)).all()
        assert all(r.ids_crc32 == zlib.crc32(all_ids[r.start:r.start + r.length].tobytes()) for r in own.itertuples())
    # Short runs cut the same way.
    monkeypatch.setattr(packing, "LONG_RUN", 2)
    monkeypatch.setattr(packing, "RUNS", re.compile(packing.RUNS.pattern.replace("100000", "2")))
    enc = packing._encoder(packing.ranks_path())
    for t in ["a  b", "  b", "b  ", "  ", " \n don't  \x1c x\x85\x85 1   !", "a \n\n  b\u2003 c", "\u200b\u200b  x"]:
        assert packing.encode(enc, t) == ids(t)


def test_sum_of_squares_choice_against_brute_force():
    rng = np.random.default_rng(3)
    p, levels = packing.Packer(16, 0, 10_000), {}
    for n in rng.integers(1, 16, 400):
        def cost(h):
            new = dict(levels)
            if h:
                new[h] -= 1
            if h + n < 16:
                new[h + n] = new.get(h + n, 0) + 1
            return sum(c * c for c in new.values())
        best = min([0, *[h for h, c in sorted(levels.items()) if c and h + n <= 16]], key=cost)
        if best:
            levels[best] -= 1
        if best + n < 16:
            levels[best + n] = levels.get(best + n, 0) + 1
        p.add(1, b"\1\0\0\0" * int(n))
        assert sum(c * c for c in levels.values()) == int((p.count ** 2).sum())
    p.drain()
    assert p.next_id == math.ceil(sum(r[2] for r in p.rows) / 16)


def test_line_dedup(spark, odd, empty):
    got = {(r["doc_id"], r["n_lines"]): r for r in line_dedup.op10(odd).collect()}
    assert line_dedup.op10(odd).count() == odd.count()
    assert got[(15, 2)]["n_dropped"] == 0 and all(got[(10 + i, 2)]["n_dropped"] == 1 for i in range(5))
    assert got[(12, 2)]["kept_sha256"] == hashlib.sha256(b"own line 2 is here and it is long enough to count too 2").hexdigest()
    assert got[(1, 1)]["kept_sha256"] == got[(2, 1)]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert line_dedup.op10(empty).count() == 0


def test_columns_named_like_the_operators_own(spark):
    """Columns with the names that the operators use inside come through unchanged."""
    names = ["_k", "_t", "_drop", "_DROP_", "_copy", "__copy", "_kept_id", "id", "cls"]
    rows = frame(spark, [(i, f"{SAME}\nown line {i}", "en") for i in range(6)]).select("doc_id", "text", "lang", *[F.lit(n).alias(n) for n in names])
    got = line_dedup.dedup_lines(rows)
    assert got.columns == [*rows.columns, "_lines", "_kept"]
    assert all([r[n] for n in names] == names and len(r["_kept"]) == (2 if r["doc_id"] == 5 else 1) for r in got.collect())
    own = line_dedup.dedup_lines(rows.withColumn("_kept", F.lit(3)).withColumn("_lines", F.lit("x")), lines="a", kept="b")
    assert {(r["_kept"], r["_lines"], len(r["a"])) for r in own.collect()} == {(3, "x", 2)}
    repeated = mixing.mixed_documents(rows, mixing.labelled_by_language(rows), mixing.TARGETS)
    assert repeated.columns == rows.columns and {tuple(r[n] for n in names) for r in repeated.collect()} == {tuple(names)}
    for op in (packing.op1, minhash.op3, simhash.op12):
        assert op(rows).count() >= 6


def test_line_positions_past_64(spark):
    body = [f"line number {i} of a long document that is its own {i}" for i in range(200)]
    rows = [(d, "\n".join([*[f"{d} {b}" for b in body], SAME, "tail", SAME]), "en") for d in range(7)]
    got = {r["doc_id"]: r for r in line_dedup.op10(frame(spark, rows)).collect()}
    assert [got[d]["n_dropped"] for d in range(7)] == [2] * 6 + [0]
    want = "\n".join([*[f"3 {b}" for b in body], "tail"])
    assert got[3]["kept_sha256"] == hashlib.sha256(want.encode()).hexdigest()


BIG = (1 << 60) + 1


def test_ids_stay_exact_beside_a_null(spark):
    """Long ids above 2^53 in the Arrow batch of a null id: pieces and components carry the ids they were given."""
    rows = [(None, "some words of a text without an id", "en"), (BIG, "one text of that id", "en"), (BIG + 1, "one text of that ID", "en"),
            (BIG + 2, "quite another text here for that", "de")]
    docs = frame(spark, rows).coalesce(1)
    assert sorted({r["doc_id"] or 0 for r in packing.op1(docs).collect()}) == [0, BIG, BIG + 1, BIG + 2]
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash.op3(docs).collect()}
    assert got == {None: (None, True), BIG: (BIG, True), BIG + 1: (BIG, False), BIG + 2: (BIG + 2, True)}


def test_near_duplicates_of_a_repeated_id(spark):
    """Rows of one id with unrelated texts: each is judged by its own text, in either order of ids."""
    a = " ".join(f"a{i}" for i in range(60))
    c = " ".join(f"c{i}" for i in range(60))
    for other in (3, 9):
        docs = frame(spark, [(7, a, "en"), (other, a + " more", "en"), (7, c, "en"), (8, c + " tail", "en")])
        got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.op3(docs).collect())
        low = min(other, 7)
        assert got == sorted([(7, low, low == 7), (other, low, low == other), (7, 7, True), (8, 7, False)])


def test_near_duplicates(spark, odd, empty):
    got = minhash.op3(odd).toPandas().set_index("doc_id", drop=False)
    assert len(got) == odd.count()
    assert got.loc[1, "n_shingles"] == got.loc[3, "n_shingles"] == 0 and got.loc[3, "component_id"] == 3
    assert (got.loc[5, "component_id"] == 5).all() and got.loc[6, "n_shingles"] == 1
    assert minhash.op3(empty).count() == 0


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows, words = [], [f"t{i}" for i in range(5000)]
    for g in range(12):
        base = list(rng.choice(words, int(rng.integers(20, 120))))
        for _ in range(int(rng.integers(1, 40))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(0, len(copy)))] = str(rng.choice(words))
            rows.append((len(rows), " ".join(copy), "en"))
    order = rng.permutation(len(rows))
    rows = [(int(order[i]), t, l) for i, t, l in rows]
    sets = {}
    for i, t, _ in rows:
        w = t.split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in minhash.op3(frame(spark, rows)).collect()}
    assert got == {i: find(i) for i in sets}


def test_estimate_tracks_similarity():
    rng = np.random.default_rng(8)
    s = np.sort(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    for share in (0.5, 0.75, 0.9):
        n = int(share * 3000)
        a, b = s[:3000], np.r_[s[:n], s[3000:3000 + 3000 - n]]
        j = n / (6000 - n)
        e = minhash.estimate(*(np.frombuffer(minhash.pack_bits(minhash.minima(x)), np.uint64) for x in (a, b)))
        assert abs(e - j) < 0.12


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["id"]: r["comp"] for r in minhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_quality(spark, odd, empty):
    labels = spark.createDataFrame([(i, int(i < 13), 0) for i in range(10, 16)] + [(None, 1, 0), (4, None, 0), (5, 0, 0), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.op6(odd, labels).toPandas()
    assert len(got) == odd.count() and got["score"].between(0, 1).all() and set(got["predicted"]) <= {0, 1}
    assert quality.op6(odd, labels.limit(0)).toPandas()["score"].eq(0.5).all()
    assert quality.op6(empty, labels).count() == 0


def test_language(spark, odd, empty):
    got = language_id.op9(odd).toPandas()
    assert len(got) == odd.count()
    by = got.drop_duplicates("doc_id").set_index("doc_id")["lang_pred"]
    assert by[1] == by[2] == by[3] == by[6] == "und" and by[4] == "en"
    assert language_id.op9(empty).count() == 0
    assert set(language_id.op9(odd.withColumn("lang", F.lit(None).cast("string"))).toPandas()["lang_pred"]) == {"und"}


def test_language_scores_match_dense_counts():
    rng = np.random.default_rng(2)
    m = language_id.LanguageModel(["a", "b"], np.log([0.5, 0.5]), rng.normal(size=(1 << 16, 2)).astype(np.float32), 16)
    text = "Über den Wolken" * 30_000   # spans several chunks
    n = sum(len(i) for i in language_id.gram_ids(text, 16))
    assert n == 3 * len(text) - 3
    counts = sum(np.bincount(i, minlength=1 << 16) for i in language_id.gram_ids(text, 16))
    assert np.allclose(m.log_scores(text), m.prior + counts @ m.table.astype(float), rtol=1e-4)


def test_mixing(spark, odd, empty):
    got = mixing.op2(odd).toPandas()
    assert len(got) == odd.count() and (got["rate"] >= 0).all() and (got["copies"] >= 1).all()
    assert mixing.op2(empty).count() == 0
    repeated = mixing.mixed_documents(odd, mixing.labelled_by_language(odd), mixing.TARGETS)
    assert repeated.columns == odd.columns and repeated.count() >= odd.count()


def test_mixing_fit_against_numpy(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 500)
    n = rng.integers(0, 900, 500)
    scored = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "tokens long, p array<double>")
    target = [0.6, 0.3, 0.1]
    gradients = mixing.fit_rates(scored, target, total=1.0)
    r = np.ones(500)
    for g in gradients:
        r = np.maximum(0, r - p @ np.array(g))
    assert np.allclose((n * r) @ p / n.sum(), target, atol=2e-4)
    got = scored.select(mixing.rate(scored["p"], gradients).alias("r")).toPandas()["r"]
    assert np.allclose(got, r)


def test_secrets(spark, odd, empty):
    rows = [(i, f"some words before password={hashlib.md5(str(i).encode()).hexdigest()[:18]} and after", "en") for i in range(40)]
    rows += [(100 + i, f"an extraordinarilylongwordnumber follows electroencephalographically{'abcdefgh'[i % 8]} text", "en") for i in range(40)]
    docs = frame(spark, rows).union(odd)
    got = secrets.op4(docs).toPandas()
    held = got[(got["doc_id"] < 40) & got["candidate"].str.fullmatch("[0-9a-f]{18}")]
    assert len(held) == 40 and held["predicted"].eq(1).all() and got.loc[got["doc_id"] >= 100, "predicted"].eq(0).all()
    assert secrets.op4(empty).count() == 0
    assert secrets.op4(odd).toPandas()["predicted"].eq(0).all()


def test_secrets_every_candidate_of_a_word(spark):
    a, b = "AKIA" + "Q7" * 8, "ghp_" + "aB3" * 12
    texts = [f"see https://static-files-example-host.com/d?token={a} here", f'{{"password":"{a}","aws_secret_access_key":"{b}"}}',
             f"x={a}&y={b}", f"db.password={a},{b}", f"{a}:{b}", f"p=q={a}==", "abcdefgh=ijklmnop", f"/x/name={a}", "k=" + "z" * 15,
             ".".join("ab" for _ in range(100_000)) + "=" + a, "é" * 40]
    got = {}
    for r in secrets.findings(frame(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect():
        got.setdefault(r["id"], []).append((r["pos"], r["match"], r["candidate"], r["near"][0]))
    assert [sorted(got.get(i, [])) for i in range(len(texts) - 2)] == [
        [(1, 0, "//static-files-example-host", "https"), (1, 1, a, "token")],
        [(0, 0, a, "password"), (0, 1, "aws_secret_access_key", ""), (0, 2, b, "awssecretaccesskey")],
        [(0, 0, a, "x"), (0, 1, b, "y")], [(0, 0, a, "dbpassword"), (0, 1, b, "")], [(0, 0, a, ""), (0, 1, b, a.lower())],
        [(0, 0, a + "==", "q")], [(0, 0, "abcdefgh=ijklmnop", "")], [(0, 0, a, "name")], [(0, 0, "k=" + "z" * 15, "")]]
    assert [x[2] for x in got[9]] == [a] and 10 not in got
    docs = frame(spark, [(i, f'{{"token":"{hashlib.md5(str(i).encode()).hexdigest()[:18]}","password":"{hashlib.md5(str(-i).encode()).hexdigest()[:18]}"}}'
                          f" an extraordinarilylongwordnumber{'abcdefgh'[i % 8]}", "en") for i in range(1, 41)])
    out = secrets.op4(docs).toPandas()
    keys = out[out["candidate"].str.fullmatch("[0-9a-f]{18}")]
    assert len(keys) == 80 and keys["predicted"].eq(1).all() and not out.duplicated(["doc_id", "pos", "match"]).any()


def test_secrets_very_long_candidates(spark):
    """Features of a candidate of two million characters take seconds: each is linear in the length."""
    rows = [(1, "blob " + "aB3/" * 500_000, "en"), (2, "x" * 2_000_000 + " token = " + "0123456789abcdef" * 3, "en"), (3, "plain words only", "en")]
    found = secrets.findings(frame(spark, rows))
    start = time.time()
    got = secrets.featured(found, [0.5] * secrets.TRIGRAMS, [0.0] * secrets.NEIGHBOURS).select("length", "coverage", "variety").collect()
    assert sorted(r["length"] for r in got) == [48, 2_000_000, 2_000_000] and time.time() - start < 60


def test_secrets_trigrams(spark):
    words = ["ab", "", "abc", "abcdefgh", "AbÇd\nxy"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", secrets._trigrams(F.col("w")).alias("t")).collect()
    for r in got:
        w = "".join(c.lower() if c.isascii() else c for c in r["w"])
        assert sorted(r["t"]) == sorted([w[i:i + 3] for i in range(len(w) - 2)] if len(w) > 2 else [w])


def test_secrets_tell_look_alikes_by_their_neighbours(spark):
    """Forty hexadecimal digits named a token, and the same shape named a commit: the forest learns the difference."""
    rows = []
    for i in range(400):
        digest = hashlib.sha1(str(i).encode()).hexdigest()
        rows.append((i, f"some words before {'token = ' if i % 2 else 'commit '}{digest} and after it", "en"))
    found = secrets.findings(frame(spark, rows))
    labelled = secrets.format_labels(found)
    assert {(r["id"] % 2, r["label"]) for r in labelled.collect()} == {(0, 0), (1, 1)}
    model = secrets.train(labelled.where("id % 4 < 2"), secrets.dictionary(frame(spark, rows)))
    held = secrets.judged(found.where("id % 4 >= 2"), model).collect()
    assert len(held) == 200 and all(r["predicted"] == r["doc_id"] % 2 for r in held)


def test_secrets_dictionary_counts_every_document(spark):
    rng = np.random.default_rng(7)
    rare = ["".join(rng.choice(list("абвгдежзийклмнопрстуфхцчшщыьэюя"), 8)) for _ in range(60)]
    docs = frame(spark, [(i, f"some common words {rare[i // 50] if i % 50 == 0 else ''}", "en") for i in range(3_000)])
    table, n = secrets.dictionary(docs), {}
    grams = [w[j:j + 3] for w in ["some", "common", "words"] * 3_000 + rare for j in range(len(w) - 2)]
    slots = spark.createDataFrame([(g,) for g in sorted(set(grams))], "g string").select("g", secrets._slot(F.col("g"), secrets.TRIGRAMS))
    slot = dict(slots.toPandas().itertuples(index=False))
    for g in grams:
        n[slot[g]] = n.get(slot[g], 0) + 1
    for s, x in enumerate(table):
        assert math.isclose(x, math.log(1 + n.get(s, 0) / len(grams) / secrets.COMMON), rel_tol=1e-9)
    assert np.allclose(table, secrets.dictionary(docs.union(docs)))   # shares, whatever the size


def test_url_rules(spark):
    urls = ["http://Example.ORG/es/x", "https://a.example.org/en/12?q=/es/", "http://notexample.org/es/", "http://example.org", None,
            "no scheme", "x://b.com/fr/1", "x://com/de/#f", "x://c.com/dex", "x://deep.a.example.org/es/z", "", "http:///path",
            "x://org/ü", "x://a.org:80/", "x://b.com/fr/1"]
    pages = spark.createDataFrame([(i % 14, u, "host", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {(r["page_id"], r["host"]): (r["path"], r["rule"], r["verdict"]) for r in url_filter.op7(pages).collect()}
    assert url_filter.op7(pages).count() == len(urls)
    assert got[(0, "example.org")] == ("/es/x", "example.org/es/", "block")
    assert got[(1, "a.example.org")] == ("/en/12", "example.org/en/1", "block")
    assert got[(2, "notexample.org")] == ("/es/", "org/", "allow")
    assert got[(3, "example.org")] == ("", None, "allow") and got[(4, "")] == ("", None, "allow")
    assert got[(6, "b.com")] == ("/fr/1", "com/fr/", "allow") and got[(7, "com")] == ("/de/", "com/de/", "block")
    assert got[(8, "c.com")] == ("/dex", None, "allow") and got[(9, "deep.a.example.org")][2] == "block"
    assert url_filter.op7(pages.limit(0)).count() == 0


def test_url_rules_nested_against_brute_force(spark):
    rng = np.random.default_rng(6)
    hosts = ["a", "b.a", "c.b.a", "d.a", "x"]
    rules = [(str(rng.choice(hosts)), "/" + "".join(rng.choice(list("pq/"), int(rng.integers(0, 5)))), str(rng.choice(["allow", "block"])))
             for _ in range(25)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    pages = [(i, "s://" + str(rng.choice(hosts + ["z.c.b.a", "aa", "y.x"])) + "/" + "".join(rng.choice(list("pq/"), int(rng.integers(0, 7)))))
             for i in range(400)]
    got = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string"),
                                spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    for r in got:
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
                if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        assert (r["rule"], r["verdict"]) == (max(fits)[2:] if fits else (None, "allow"))


def test_vectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 8))
    x[100:160] = x[40]                                   # many ties
    rows = [(i, [float(v) for v in e], 0.5) for i, e in enumerate(x)]
    rows += [(1000, None, 0.0), (1020, [0.0] * 8, 0.0), (1040, [float("nan")] * 8, 0.0), (1060, [1.0, None] + [0.0] * 6, 0.0),
             (1080, [1.0] * 5, 0.0), (None, [1.0] * 8, 0.0), rows[20], rows[21]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    got = vector_search.op8(df).toPandas()
    assert set(got["query_id"]) == set(range(0, 600, 20))
    hit = 0
    for q, own in got.groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(own["vec_id"]) & set(np.lexsort((np.arange(600), -s))[:20]))
        own = own.sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21)) and np.allclose(own["score"], s[own["vec_id"]])
        assert list(zip(-own["score"], own["vec_id"])) == sorted(zip(-own["score"], own["vec_id"]))
    assert hit / 600 >= 0.9
    assert vector_search.op8(df.limit(0)).count() == 0


def test_vectors_of_small_tables(spark):
    rng = np.random.default_rng(3)
    for n in (2, 12, 22, 40):
        x = rng.normal(size=(n, 64))
        df = spark.createDataFrame([(i, [float(v) for v in e]) for i, e in enumerate(x)], "vec_id long, embedding array<double>")
        got = vector_search.nearest(df, df).toPandas()
        assert set(got["query_id"]) == set(range(n))
        for q, own in got.groupby("query_id"):
            s = x @ x[q]
            s[q] = -np.inf
            assert list(own.sort_values("rank")["vec_id"]) == list(np.argsort(-s, kind="stable")[:min(20, n - 1)])


def test_probe_passes_over_empty_leaves():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 64))
    f = vector_search.fit_forest(x, np.linalg.norm(x, axis=1).max(), 16, 7)
    codes = f.leaves(x) + (np.arange(16) << 7)
    sizes = np.bincount(codes.ravel(), minlength=16 << 7)
    for q in x:
        assert sizes[f.probe(q, 110, sizes, 0)].all() and len(f.probe(q, 110, sizes, 0)) == 110
        met = f.probe(q, 1, sizes, 21)
        assert np.isin(codes, met).any(axis=1).sum() >= 21
        assert np.isin(codes, f.probe(q, 1, sizes, 41)).any(axis=1).all()


def test_bm25_outside_queries(spark):
    docs = frame(spark, [(i, f"shared words here unique{i}", "en") for i in range(30)])
    asked = frame(spark, [(1000, "shared unique7", "en"), (1001, "unique9 nowhere", "en"), (5, "unique5", "en"), (6, "unique8", "en")])
    got = bm25.search(docs, asked).toPandas()
    best = got[got["rank"] == 1].set_index("query_id")["doc_id"].to_dict()
    assert best == {1000: 7, 1001: 9, 6: 8} and (got["query_id"] == 1001).sum() == 1
    first = got[(got["query_id"] == 1000)].sort_values("rank")["score"].to_numpy()
    idf = lambda df: math.log(1 + (30 - df + .5) / (df + .5))
    assert np.allclose(first[:2], [idf(30) + idf(1), idf(30)])


def test_bm25(spark, odd, empty):
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(f"v{min(int(z), 400)}" for z in rng.zipf(1.3, int(rng.integers(0, 60)))), "en") for i in range(300)]
    rows += [(301, rows[50][1], "en"), (302, rows[50][1], "en")]
    docs = frame(spark, rows)
    got = bm25.search(docs, docs.where("doc_id % 50 = 0")).toPandas()
    tf = {i: {} for i, _, _ in rows}
    for i, t, _ in rows:
        for w in t.split():
            tf[i][w] = tf[i].get(w, 0) + 1
    n, mean = len(rows), sum(sum(c.values()) for c in tf.values()) / len(rows)
    df = {}
    for c in tf.values():
        for w in c:
            df[w] = df.get(w, 0) + 1
    for q in range(0, 301, 50):
        want = []
        for i, c in tf.items():
            s = sum(f * math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * c[w] * 2.2 / (c[w] + 1.2 * (.25 + .75 * sum(c.values()) / mean))
                    for w, f in tf.get(q, {}).items() if w in c)
            if s > 0 and i != q:
                want.append((-round(s, 8), i))
        own = got[got["query_id"] == q].sort_values("rank")
        assert [i for _, i in sorted(want)[:10]] == list(own["doc_id"])
        assert np.allclose([-s for s, _ in sorted(want)[:10]], own["score"])
    assert bm25.op5(empty).count() == 0
    assert set(bm25.search(odd, odd).toPandas()["query_id"]) >= {5, 10, 15}


def test_bm25_shards_and_blocks(monkeypatch):
    """Frequent and seldom words, many shards, equal texts in several of them: as scoring every document."""
    import pandas as pd
    monkeypatch.setattr(bm25, "FREQUENT", 12)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{i % 3}v{min(int(z), 300)}" for z in rng.zipf(1.25, int(rng.integers(0, 80)))) for i in range(900)]
    texts += [texts[17]] * 25 + ["", texts[400]]
    rows = [bm25.terms_of(t) for t in texts]
    words = np.array([r[2] for r in rows])
    terms, df = np.unique(np.concatenate([r[0] for r in rows]), return_counts=True)
    idf = np.log(1 + (len(rows) - df + .5) / (df + .5))
    asked = [i for i in range(0, 927, 10) if words[i]]
    at = [np.searchsorted(terms, rows[i][0]) for i in asked]
    queries = bm25.Queries(np.array(asked), np.array([len(a) for a in at]), np.concatenate([rows[i][0] for i in asked]),
                           np.concatenate([rows[i][1] * idf[a] for i, a in zip(asked, at)]), np.concatenate([df[a] for a in at]))
    table = pd.DataFrame({"id": range(len(rows)), "words": words, "terms": [r[0].tobytes() for r in rows],
                          "freqs": [r[1].tobytes() for r in rows]}).sample(frac=1, random_state=1)
    best = [(np.empty(0), np.empty(0, np.int64)) for _ in asked]
    for lo in range(0, len(table), 130):
        shard = bm25.Shard(table.iloc[lo:lo + 130].reset_index(drop=True), queries, words.mean())
        for q in range(0, len(asked), 16):
            shard.search(queries, q, min(q + 16, len(asked)), 10, best)
    for q, query_id in enumerate(queries.ids):
        weight = dict(zip(rows[query_id][0].tolist(), (rows[query_id][1] * idf[np.searchsorted(terms, rows[query_id][0])]).tolist()))
        want = []
        for i, (t, f, n) in enumerate(rows):
            s = sum(weight.get(x, 0) * y * 2.2 / (y + 1.2 * (.25 + .75 * n / words.mean())) for x, y in zip(t.tolist(), f.tolist()))
            if s > 0 and i != query_id:
                want.append((-round(s, 8), i))
        assert [i for _, i in sorted(want)[:10]] == best[q][1].tolist()
        assert np.allclose([-s for s, _ in sorted(want)[:10]], best[q][0])


def test_bm25_tiles_serve_every_query_block(monkeypatch):
    """Tiles are cut once for all query blocks; dense or by lists, scores are those of every document, bit for bit the same."""
    monkeypatch.setattr(bm25, "TILE_DOCS", 100)
    monkeypatch.setattr(bm25, "TILE_POSTINGS", 2_500)
    rng = np.random.default_rng(8)
    texts = [" ".join(f"{'abcd'[i % 4]}{min(int(z), 500)}" for z in rng.zipf(1.2, int(rng.integers(0, 90)))) for i in range(700)]
    texts += [texts[5]] * 15 + ["", " ".join(f"a{i}" for i in range(3000)), texts[44]]
    rows = [bm25.terms_of(t) for t in texts]
    ids, words = np.arange(len(rows)), np.array([r[2] for r in rows])
    ids[-1] = 44                                     # a second row of one id: no result of its own query
    terms, df = np.unique(np.concatenate([r[0] for r in rows]), return_counts=True)
    idf = np.log(1 + (len(rows) - df + .5) / (df + .5))
    index = list(bm25.tiles(ids, words, [r[0] for r in rows], [r[1] for r in rows]))
    assert sum(t["docs"] for t in index) == len(rows) and sum(t["total"] for t in index) == words.sum()
    assert max(t["docs"] for t in index) == 100 and max(len(t["term"]) // 4 for t in index if t["docs"] > 1) <= 2_500
    asked = [i for i in range(0, 717, 7) if words[i]] + [716]
    blocks, found = (asked[:50], asked[50:]), []
    for dense in (0.0, 0.003, 2.0):                  # all words that may be dense, some, none
        monkeypatch.setattr(bm25, "DENSE", dense)
        got = {}
        for block in blocks:
            at = [np.searchsorted(terms, rows[i][0]) for i in block]
            queries = bm25.Queries(np.array(block), np.array([len(a) for a in at]), np.concatenate([rows[i][0] for i in block]),
                                   np.concatenate([rows[i][1] * idf[a] for i, a in zip(block, at)]), np.concatenate([df[a] for a in at]))
            best = [(np.empty(0), np.empty(0, np.int64)) for _ in block]
            for part in (index[:3], index[3:]):
                shard = bm25.Shard([bm25.Tile(t, queries, words.mean()) for t in part], queries, words.mean())
                for lo in range(0, len(block), 16):
                    shard.search(queries, lo, min(lo + 16, len(block)), 10, best)
            got |= dict(zip(queries.ids.tolist(), best))
        found.append(got)
    for q in asked:
        weight = dict(zip(rows[q][0].tolist(), (rows[q][1] * idf[np.searchsorted(terms, rows[q][0])]).tolist()))
        want = []
        for i, (t, f, n) in zip(ids.tolist(), rows):
            s = sum(weight.get(x, 0) * y * 2.2 / (y + 1.2 * (.25 + .75 * n / words.mean())) for x, y in zip(t.tolist(), f.tolist()))
            if s > 0 and i != q:
                want.append((-round(s, 8), i))
        assert [i for _, i in sorted(want)[:10]] == found[0][q][1].tolist()
        assert np.allclose([-s for s, _ in sorted(want)[:10]], found[0][q][0])
        assert all(np.array_equal(found[0][q][j], other[q][j]) for other in found[1:] for j in (0, 1))


def test_held_out_accuracy_and_clean_documents(spark):
    """Whole sf0.01 tables: language and quality against the given labels on the held-out folds."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lang = language_id.op9(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred != 'und'").toPandas()
    assert (lang["lang"] == lang["lang_pred"]).mean() > 0.95
    q = quality.op6(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (q["quality"] == q["predicted"]).mean() > 0.9
    assert q.loc[q["quality"] == 1, "predicted"].mean() > 0.97
