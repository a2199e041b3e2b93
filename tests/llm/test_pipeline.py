"""Each pipeline stage on what its predecessor kept (sf0.001), against plain Python where it decides."""

import collections

import corpus_pipeline
from tests.conftest import SF0
from tests.llm.test_edges import ids


def test_stages(spark):
    docs = spark.read.parquet(f"{SF0}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF0).cache()
        assert docs.columns == columns, name
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    quality, lines, near, mixed = kept
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})
    holders = collections.defaultdict(set)
    for i, t in quality.items():
        for line in t.split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    gone = {k: max(d) for k, d in holders.items() if len(d) >= 5}
    assert lines == {i: "\n".join(x for x in t.split("\n") if gone.get(key(x), i) <= i) for i, t in quality.items()}
    assert set(near) <= set(lines) and set(mixed) == set(near) and docs.count() >= len(near)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF0).toPandas()
    n = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    want = {i: c * (len(ids(near[i])) + 1) for i, c in n.items()}
    assert pieces.groupby("doc_id")["length"].sum().to_dict() == want
