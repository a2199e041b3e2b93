"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import (bm25, language_id, line_dedup, minhash, mixing, packing, prefix_trie, quality, secrets, simhash,
                          url_filter, vector_search, whitening)
from tidemark.llm.common import table

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_pack": lambda s, d: packing.op1(table(s, d, "documents")),
    "op2_mix": lambda s, d: mixing.op2(table(s, d, "documents")),
    "op3_minhash": lambda s, d: minhash.op3(table(s, d, "documents")),
    "op4_secrets": lambda s, d: secrets.op4(table(s, d, "documents")),
    "op5_bm25": lambda s, d: bm25.op5(table(s, d, "documents")),
    "op6_quality": lambda s, d: quality.op6(table(s, d, "documents"), table(s, d, "labels")),
    "op7_url_rules": lambda s, d: url_filter.op7(table(s, d, "pages")),
    "op8_vectors": lambda s, d: vector_search.op8(table(s, d, "embeddings")),
    "op9_language": lambda s, d: language_id.op9(table(s, d, "documents")),
    "op10_line_dedup": lambda s, d: line_dedup.op10(table(s, d, "documents")),
    "op11_whiten": lambda s, d: whitening.op11(table(s, d, "embeddings")),
    "op12_simhash": lambda s, d: simhash.op12(table(s, d, "documents")),
    "op13_prefix_trie": lambda s, d: prefix_trie.op13(table(s, d, "conversations")),
}

ORACLE = {
    "op7_url_rules": url_filter.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
