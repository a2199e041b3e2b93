"""Exact top-k BM25 search: inverted indexes of tiles of documents, scored in single precision first, exact global statistics.

Every document is hashed once. Runs of documents are sorted so that alike ones lie together and cut into tiles; a tile's
inverted and forward lists are written once and read by every query block. Document frequencies, document count and mean
length are global, so results of tiles merge exactly. Queries come in blocks of bounded size, and a task takes them in
batches of alike ones. For each batch and tile, words that many of the queries and many of the documents share are
multiplied as dense matrices, the other words by their posting lists. Sums are in single precision with a bound on their
error; what may reach the k-th best score by that bound is scored again in double precision, in an order that depends on
the query alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_rows, scan_rows
from tidemark.llm.textnum import LOWER, word_hashes
from tidemark.operators.materialize import materialize

K1, B = 1.2, 0.75
SHARD_DOCS, SHARD_POSTINGS = 8_192, 3_000_000    # documents sorted, or searched, together: a shard ends at either bound
DOC_BITS = 11                                    # of a posting; its other bits are the impact
TILE_DOCS, TILE_POSTINGS = 1 << DOC_BITS, 500_000   # a tile ends at either bound
WRITER = {"maxRecordsPerFile": 8, "parquet.page.row.count.limit": 1}   # a tile per page: bounds what is held of large rows
BATCH_DOCS = 256                                 # documents per Arrow batch
FREQUENT = 1_024                                 # words of a batch and of a tile that may be taken as dense, at most
DENSE = 0.003                                    # dense from this share of (query, document) pairs with the word on
ALIKE = 128                                      # most frequent words by which documents are found alike
QUERY_BATCH = 256                                # queries that share a pass over a tile
QUERY_TERMS = 1_400_000                          # terms of a query block: what is broadcast
CHUNK = 100_000                                  # postings added up in one step
TABLE = 1_000_000                                # cells of the table for exact scores
ROUNDING = 2.0 ** -23                            # twice the relative error of single precision, for each term of a sum


def terms_of(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted distinct word hashes (A-Z lower-cased), their frequencies, and the number of words."""
    w = word_hashes((text or "").encode("utf-8", "surrogatepass").translate(LOWER)).view(np.int64)
    t, n = np.unique(w, return_counts=True)
    return t, n.astype(np.int32), len(w)


def term_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, words, terms, freqs)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [terms_of(t) for t in pdf["t"]]
            yield pd.DataFrame({"id": pdf["id"], "words": [r[2] for r in rows], "terms": pd.Series([r[0] for r in rows], dtype=object),
                                "freqs": pd.Series([r[1] for r in rows], dtype=object)})

    return _texts(docs, key, text).mapInPandas(run, "id long, words long, terms array<long>, freqs array<int>")


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).where("id IS NOT NULL")


def alike(first: np.ndarray, terms: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Order of rows: those with the same frequent words together, by the signs of principal directions, then by length.

    Row ``i`` has ``terms[first[i]:first[i + 1]]``. The order bears on speed only.
    """
    some, n = np.unique(terms[:first[min(len(words), TILE_DOCS)]], return_counts=True)
    top = np.sort(some[np.lexsort((some, -n))[:ALIKE]])
    if len(top) < 3:
        return np.argsort(words, kind="stable")
    at = np.searchsorted(top, terms)
    at[at == len(top)] = 0
    own = np.flatnonzero(top[at] == terms)
    x = np.zeros((len(words), len(top)), np.float32)
    x[np.searchsorted(first, own, side="right") - 1, at[own]] = 1
    x /= np.maximum(np.sqrt(x.sum(axis=1, keepdims=True)), 1)
    x -= x.mean(axis=0)
    side = x @ np.linalg.eigh(x.T @ x)[1][:, -3:] > 0
    return np.lexsort((words, side @ np.array([1, 2, 4])))


def _narrow(counts: np.ndarray) -> bytes:
    return counts.astype(np.uint16 if not len(counts) or counts.max() < 1 << 16 else np.int32).tobytes()


def _counts(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.int32)


TILE_SCHEMA = ("docs long, total long, ids binary, words binary, sizes binary, vocabulary binary, df binary, "
               "term binary, freq binary, doc binary, doc_freq binary")


def tiles(ids: np.ndarray, words: np.ndarray, terms: list[np.ndarray], freqs: list[np.ndarray]) -> Iterator[dict]:
    """Rows of ``TILE_SCHEMA`` of a run of documents.

    ``ids``, ``words``, ``sizes``: of the documents; ``term`` (number in ``vocabulary``) and ``freq``: of each document's
    terms; ``df``: of the vocabulary; ``doc`` (number in the tile) and ``doc_freq``: the posting list of each term.
    """
    sizes = np.array([len(t) for t in terms], np.int64)
    first = np.r_[0, np.cumsum(sizes)]
    term, freq = np.concatenate([np.empty(0, np.int64), *terms]), np.concatenate([np.empty(0, np.int32), *freqs])
    order = alike(first, term, words)
    held = np.cumsum(sizes[order])
    lo = 0
    while lo < len(order):
        before = held[lo - 1] if lo else 0
        hi = max(lo + 1, min(lo + TILE_DOCS, int(np.searchsorted(held, before + TILE_POSTINGS, side="right"))))
        own = order[lo:hi]
        post = _ranges(first[own], sizes[own])
        t, f = term[post], freq[post]
        by_term = np.argsort(t, kind="stable")
        t = t[by_term]
        start = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.empty(0, np.int64)
        df = np.diff(np.r_[start, len(t)]).astype(np.int32)
        number = np.empty(len(t), np.int32)
        number[by_term] = np.repeat(np.arange(len(df), dtype=np.int32), df)
        doc = np.repeat(np.arange(len(own), dtype=np.int32), sizes[own])[by_term]
        yield {"docs": len(own), "total": int(words[own].sum()), "ids": ids[own].tobytes(), "words": words[own].tobytes(),
               "sizes": sizes[own].astype(np.int32).tobytes(), "vocabulary": t[start].tobytes(), "df": df.tobytes(),
               "term": number.tobytes(), "freq": _narrow(f), "doc": doc.astype(np.uint16).tobytes(), "doc_freq": _narrow(f[by_term])}
        lo = hi


def tile_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Tiles of all documents; runs do not cross partitions."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def cut(rows: list[tuple]) -> Iterator[pd.DataFrame]:
            ids, terms, freqs, words = zip(*rows)
            for tile in tiles(np.array(ids, np.int64), np.array(words, np.int64), terms, freqs):
                yield pd.DataFrame([tile])

        rows, postings = [], 0
        for pdf in batches:
            for i, t in zip(pdf["id"], pdf["t"]):
                rows.append((i, *terms_of(t)))
                postings += len(rows[-1][1])
                if len(rows) >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield from cut(rows)
                    rows, postings = [], 0
        if rows:
            yield from cut(rows)

    return _texts(docs, key, text).mapInPandas(run, TILE_SCHEMA)


def document_frequency(index: DataFrame) -> DataFrame:
    """(term, df, holder) of a tile table, counted in each task before the shuffle; ``holder``: an id with the term."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def counted(held: list[tuple]) -> pd.DataFrame:
            term, n, holder = (np.concatenate(x) for x in zip(*held))
            t, first, at = np.unique(term, return_index=True, return_inverse=True)
            return pd.DataFrame({"term": t, "n": np.bincount(at, weights=n, minlength=len(t)).astype(np.int64), "holder": holder[first]})

        held, size = [], 0
        for pdf in batches:
            for r in pdf.itertuples():
                df = np.frombuffer(r.df, np.int32)
                start = np.cumsum(df, dtype=np.int64) - df
                held.append((np.frombuffer(r.vocabulary, np.int64), df, np.frombuffer(r.ids, np.int64)[np.frombuffer(r.doc, np.uint16)[start]]))
                size += len(df)
                if size >= QUERY_TERMS // 2:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    return index.select("ids", "vocabulary", "df", "doc").mapInPandas(run, "term long, n long, holder long").groupBy("term") \
        .agg(F.sum("n").alias("df"), F.max("holder").alias("holder"))


class Batch:
    """Queries that share a pass over a tile; the terms of each lie in the order in which exact scores are summed."""

    def __init__(self, at: list[np.ndarray], weights: list[np.ndarray], column: np.ndarray):
        self.queries, self.sizes = len(at), np.array([len(a) for a in at], np.int64)
        self.first = np.r_[0, np.cumsum(self.sizes)]
        at, weights = np.concatenate(at), np.concatenate(weights)
        row = np.repeat(np.arange(self.queries, dtype=np.int32), self.sizes)
        late = np.maximum(column[at], -1)
        order = np.lexsort((late, row))        # stable: seldom words by their hash, then frequent ones by their column
        self.row, self.weight, self.late = row, weights[order], (late >= 0)[order]
        self.single = self.weight.astype(np.float32)
        self.terms, own, count = np.unique(at[order], return_inverse=True, return_counts=True)
        self.term, self.count = own.astype(np.int32), count.astype(np.int64)
        self.frequent = np.sort(np.argsort(-count, kind="stable")[:FREQUENT])
        place = np.full(len(self.terms), -1, np.int32)
        place[self.frequent] = np.arange(len(self.frequent))
        place = place[self.term]
        some = place >= 0
        self.dense = np.zeros((len(self.frequent), self.queries), np.float32)
        self.dense[place[some], row[some]] = self.single[some]
        self.slack = (self.sizes + 16 + (1 << DOC_BITS + 1)) * ROUNDING


class Queries:
    """A block of queries: weights of vocabulary positions, alike queries together."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, df: np.ndarray):
        """``terms``, their ``weights`` and ``df``: those of the first query (``sizes[0]`` of them), of the second, and so on."""
        order = alike(np.r_[0, np.cumsum(sizes)], terms, np.asarray(sizes))
        self.vocabulary, first, at = np.unique(terms, return_index=True, return_inverse=True)
        most = np.lexsort((self.vocabulary, -df[first]))[:FREQUENT]
        self.column = np.full(len(self.vocabulary), -1, np.int32)     # of a frequent word
        self.column[most] = np.arange(len(most))
        cut = np.cumsum(sizes)[:-1]
        at, weights = np.split(at.astype(np.int32), cut), np.split(weights, cut)
        self.ids = ids[order]
        self.at, self.weights = [at[q] for q in order], [weights[q] for q in order]
        self.batches: dict[tuple[int, int], Batch] = {}

    def batch(self, lo: int, hi: int) -> Batch:
        if (lo, hi) not in self.batches:
            self.batches[lo, hi] = Batch(self.at[lo:hi], self.weights[lo:hi], self.column)
        return self.batches[lo, hi]


class Tile:
    """One row of a tile table, over the terms of a query block."""

    def __init__(self, row: dict, queries: Queries, mean: float):
        self.ids, words = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["words"], np.int64)
        self.sizes, self.df = np.frombuffer(row["sizes"], np.int32).astype(np.int64), np.append(np.frombuffer(row["df"], np.int32), 0)
        self.term = np.frombuffer(row["term"], np.int32)
        self.freq, freq = _counts(row["freq"], len(self.term)), _counts(row["doc_freq"], len(self.term)).astype(np.float32)
        doc, vocabulary = np.frombuffer(row["doc"], np.uint16), np.frombuffer(row["vocabulary"], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.norm = K1 * (1 - B + B * words / mean)
        # A posting: the impact in single precision, its last bits replaced by the document.
        impact = freq * np.float32(K1 + 1) / (freq + self.norm.astype(np.float32)[doc])
        self.post = (impact.view(np.int32) & np.int32(-1 << DOC_BITS)) | doc
        self.start = np.cumsum(self.df, dtype=np.int64) - self.df
        at = np.searchsorted(queries.vocabulary, vocabulary)
        at[at == len(queries.vocabulary)] = 0
        own = np.flatnonzero(queries.vocabulary[at] == vocabulary)
        self.local = np.full(len(queries.vocabulary), -1, np.int32)      # number here of a term of the queries, or the last, which has no documents
        self.local[at[own]] = own
        often = own[np.argsort(-self.df[own], kind="stable")[:FREQUENT]]
        doc, impact = self._postings(_ranges(self.start[often], self.df[often]))
        self.dense = np.zeros((len(often), len(self.ids)), np.float32)
        self.dense[np.repeat(np.arange(len(often)), self.df[often]), doc] = impact
        self.place = np.full(len(self.df), -1, np.int32)                 # row of a frequent word
        self.place[often] = np.arange(len(often))

    def _postings(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        post = self.post.take(at)
        return post & np.int32((1 << DOC_BITS) - 1), post.view(np.float32)

    def score(self, batch: Batch, total: np.ndarray) -> None:
        """Scores of all documents for each query into ``total``, a part of the columns of a matrix, in single precision."""
        local = self.local[batch.terms]
        df, place = self.df[local], self.place[local[batch.frequent]]
        many = batch.count[batch.frequent] * df[batch.frequent] > DENSE * batch.queries * len(self.ids)
        used = np.flatnonzero((place >= 0) & many)
        np.matmul(batch.dense[used].T, self.dense[place[used]], out=total)
        df[batch.frequent[used]] = 0
        n = df[batch.term]
        left = np.flatnonzero(n)
        n, start, weight = n[left], self.start[local][batch.term[left]], batch.single[left]
        step = total.strides[0] // 4
        row = batch.row[left] * np.int64(step)
        flat = np.lib.stride_tricks.as_strided(total, ((batch.queries - 1) * step + len(self.ids),), (4,))
        held, lo, ahead = np.cumsum(n, dtype=np.int64), 0, np.arange(CHUNK + len(self.ids))
        start -= held - n
        while lo < len(left):
            before = held[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(held, before + CHUNK)))
            c = n[lo:hi]
            post = np.repeat(start[lo:hi] + before, c)
            post += ahead[:len(post)]
            doc, impact = self._postings(post)
            at, share = np.repeat(row[lo:hi], c), np.repeat(weight[lo:hi], c)
            at += doc
            share *= impact
            np.add.at(flat, at, share)
            lo = hi

    def exact(self, batch: Batch, query: np.ndarray, doc: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Scores of pairs in double precision. Equal texts have equal scores wherever they lie. ``table``: zeros, before and after."""
        local = self.local[batch.terms]
        own = np.flatnonzero(local >= 0)
        number = np.full(len(self.df), -1, np.int32)
        number[local[own]] = own
        out, order, width = np.empty(len(doc)), np.argsort(doc, kind="stable"), len(batch.terms)
        query, doc = query[order], doc[order]
        docs, each = np.unique(doc, return_index=True)
        each = np.append(each, len(doc))
        step = len(table) // width
        for lo in range(0, len(docs), step):
            d = docs[lo:lo + step]
            post, at = _ranges(self.begin[d], self.sizes[d]), np.repeat(np.arange(len(d)), self.sizes[d])
            term = number[self.term[post]]
            some = np.flatnonzero(term >= 0)
            at, term, freq = at[some], term[some], self.freq[post[some]].astype(np.int32)
            cell = at * width + term
            table[cell] = freq * (K1 + 1) / (freq + self.norm[d[at]])
            of, to = each[lo], each[min(lo + step, len(docs))]
            q, n = query[of:to], batch.sizes[query[of:to]]
            terms = _ranges(batch.first[q], n)
            parts = table[np.repeat(np.searchsorted(d, doc[of:to]) * width, n) + batch.term[terms]] * batch.weight[terms]
            table[cell] = 0
            sums = np.bincount(np.repeat(2 * np.arange(to - of), n) + batch.late[terms], weights=parts, minlength=2 * (to - of))
            out[order[of:to]] = sums[::2] + sums[1::2]
        return out


class Shard:
    """Tiles that are searched together."""

    def __init__(self, rows: list[Tile] | pd.DataFrame, queries: Queries, mean: float):
        """``rows``: tiles over ``queries``, or documents as (id, words, terms, freqs), the last two as bytes."""
        if not isinstance(rows, list):
            rows = [Tile(r, queries, mean) for r in tiles(
                rows["id"].to_numpy(), rows["words"].to_numpy(), [np.frombuffer(t, np.int64) for t in rows["terms"]],
                [np.frombuffer(f, np.int32) for f in rows["freqs"]])]
        self.tiles = rows
        self.edge = np.cumsum([0, *(len(t.ids) for t in self.tiles)])
        self.ids = np.concatenate([np.empty(0, np.int64), *(t.ids for t in self.tiles)])
        self.by_id = np.argsort(self.ids, kind="stable")
        self.total, self.table = np.empty((0, len(self.ids)), np.float32), np.zeros(TABLE)

    def search(self, queries: Queries, lo: int, hi: int, k: int, best: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Bring ``best`` (scores, ids: descending scores, ties to the smaller id, at most ``k``) of queries lo..hi up to date."""
        batch, width = queries.batch(lo, hi), len(self.ids)
        if len(self.total) < hi - lo:
            self.total = np.empty((hi - lo, width), np.float32)
        if len(self.table) < len(batch.terms):
            self.table = np.zeros(len(batch.terms))
        total = self.total[:hi - lo]
        for tile, at in zip(self.tiles, self.edge):
            tile.score(batch, total[:, at:at + len(tile.ids)])
        left, right = (np.searchsorted(self.ids[self.by_id], queries.ids[lo:hi], side=s) for s in ("left", "right"))
        for q in np.flatnonzero(right > left):       # its own rows are no results
            total[q, self.by_id[left[q]:right[q]]] = 0
        floor = np.array([s[-1] if len(s) == k else 0.0 for s, _ in best[lo:hi]]) * (1 - batch.slack)
        for q in np.flatnonzero(floor <= 0) if width > k else ():
            floor[q] = np.partition(total[q], -k)[-k] * (1 - 2 * batch.slack[q])
        hits = np.flatnonzero(total >= np.maximum(floor, 1e-30).astype(np.float32)[:, None])
        if not len(hits):
            return
        query, doc = np.divmod(hits, width)
        n = np.bincount(query, minlength=hi - lo)
        first, keep = np.cumsum(n) - n, np.ones(len(hits), bool)
        for q in np.flatnonzero(n > k):
            some = slice(first[q], first[q] + n[q])
            score = total[q, doc[some]]
            keep[some] = score >= np.partition(score, -k)[-k] * (1 - 2 * batch.slack[q])
        query, doc = query[keep], doc[keep]
        score, tile = np.empty(len(doc)), np.searchsorted(self.edge, doc, side="right") - 1
        for i in np.unique(tile):
            own = np.flatnonzero(tile == i)
            score[own] = self.tiles[i].exact(batch, query[own], doc[own] - self.edge[i], self.table)
        cut = np.flatnonzero(np.r_[True, query[1:] != query[:-1], True])
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            scores, ids = best[lo + query[a]]
            scores, ids = np.r_[scores, score[a:b]], np.r_[ids, self.ids[doc[a:b]]]
            top = np.lexsort((ids, -scores))[:k]
            best[lo + query[a]] = scores[top], ids[top]


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0] .. start[0]+n[0]-1, start[1] .. and so on."""
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)


def _collected(rows: DataFrame) -> Queries:
    """The queries of one block, as flat arrays."""
    t = rows.toArrow()
    flat = [t[c].combine_chunks() for c in ("terms", "weights", "dfs")]
    return Queries(t["id"].to_numpy(), flat[0].value_lengths().to_numpy(), *(c.flatten().to_numpy() for c in flat))


def _search_block(index: DataFrame, queries: Queries, mean: float, k: int, tasks: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries = shared.value
        best = [(np.empty(0), np.empty(0, np.int64)) for _ in queries.ids]

        def shard(held: list[Tile]) -> None:
            s = Shard(held, queries, mean)
            for lo in range(0, len(best), QUERY_BATCH):
                s.search(queries, lo, min(lo + QUERY_BATCH, len(best)), k, best)

        held, docs, size = [], 0, 0
        for pdf in batches:
            for row in pdf.to_dict("records"):
                held.append(Tile(row, queries, mean))
                docs, size = docs + row["docs"], size + len(held[-1].term)
            if docs >= SHARD_DOCS or size >= SHARD_POSTINGS:
                shard(held)
                held, docs, size = [], 0, 0
        if held:
            shard(held)
        some = [q for q in range(len(best)) if len(best[q][0])]
        if some:
            yield pd.DataFrame({"query_id": queries.ids[some], "doc_ids": pd.Series([best[q][1] for q in some], dtype=object),
                                "scores": pd.Series([best[q][0] for q in some], dtype=object)})

    with arrow_rows(index.sparkSession, 1), scan_rows(index.sparkSession, 1):
        found = materialize(index.coalesce(tasks).mapInPandas(run, "query_id long, doc_ids array<long>, scores array<double>"), "best")
    shared.destroy()
    return found


def search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", k: int = 10,
           query_block: int = 8192) -> DataFrame:
    """(query_id, rank, doc_id, score): the exact ``k`` best documents per query by BM25, its own id left out.

    Every word of a query counts, as often as it occurs; only documents that share a word are results. Ties go to the
    smaller id. Null ids take no part; null, empty and wordless texts match nothing but count in the statistics;
    repeated rows are separate candidates (and queries with one id are one query: the longest). Empty tables give no
    rows; columns other than ``key`` and ``text`` are ignored. Per pass about ``query_block`` queries are broadcast, fewer
    if they are long. The tasks follow the cluster's cores, since each passes on k results per query.
    """
    spark = docs.sparkSession
    with arrow_rows(spark, BATCH_DOCS):
        index = materialize(tile_table(docs, key, text), "tiles", **WRITER)
        asked = materialize(term_table(queries, key, text).groupBy("id").agg(
            F.max_by(F.struct("terms", "freqs"), F.struct("words", "terms")).alias("t")), "asked")
        n, total = index.agg(F.sum("docs"), F.sum("total")).first()
        n, mean = n or 0, (total or 0) / (n or 1)
    with arrow_rows(spark, 1), scan_rows(spark, 1):
        frequency = document_frequency(index)
        idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        # A term of the query's own document alone cannot find another.
        weighed = asked.select("id", F.explode(F.arrays_zip("t.terms", "t.freqs")).alias("t")) \
            .select("id", F.col("t.terms").alias("term"), F.col("t.freqs").alias("freq")).join(frequency, "term") \
            .where("df > 1 OR holder != id") \
            .select("id", "term", (F.col("freq") * idf).alias("weight"), "df")
        weighed = materialize(
            weighed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "weight", "df"))).alias("t"))
            .select("id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"), F.col("t.df").alias("dfs")), "queries")
    count, size = weighed.agg(F.count("*"), F.sum(F.size("terms"))).first()
    blocks = max(1, -(-count // query_block), -(-(size or 0) // QUERY_TERMS))
    tasks = max(1, min(-(-n // (2 * TILE_DOCS)), 2 * spark.sparkContext.defaultParallelism))
    found = None
    for part in range(blocks):
        some = _collected(weighed.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == part).orderBy("id"))
        if len(some.ids):
            rows = _search_block(index, some, mean or 1.0, k, tasks)
            found = rows if found is None else found.union(rows)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    each = found.select("query_id", F.explode(F.arrays_zip("doc_ids", "scores")).alias("x")) \
        .select("query_id", F.col("x.doc_ids").alias("doc_id"), F.col("x.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def op5(docs: DataFrame) -> DataFrame:
    return search(docs, docs.where("doc_id % 50 = 0"))
