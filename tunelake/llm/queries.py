"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from tunelake.llm import (lexical_search, line_crf, line_dedup, mixing, ngram_join, order_minhash, packing,
                          periodic_runs, pii, quality_rules, toxicity, url_filter, warc)

QUERIES = {
    "op1_ngram_jaccard": ngram_join.op1_ngram_jaccard,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_packing": packing.op3_packing,
    "op4_mixing": mixing.op4_mixing,
    "op5_pii": pii.op5_pii,
    "op6_quality": line_crf.op6_quality,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_warc": warc.op8_warc,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_order_minhash": order_minhash.op10_order_minhash,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
ORACLE = {
    "op1_ngram_jaccard": ngram_join.ORACLE,
    "op2_url_filter": url_filter.ORACLE,
    "op8_warc": warc.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op11_lexical_search": lexical_search.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
}
