"""Registered queries of the training-data operators, and their DuckDB SQL where there is one."""

from __future__ import annotations

from lakestar.llm import (
    alignment,
    exact_dedup,
    hard_negatives,
    id_coder,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    perplexity,
    pitman_yor,
    quality_classifier,
    repeated_substrings,
    secret_scan,
)

QUERIES = {
    "op11_secret_scan": secret_scan.op11_secret_scan,
    "op12_slot_negatives": hard_negatives.op12_slot_negatives,
    "op13_align_tokens": alignment.op13_align_tokens,
    "op2_id_coder": id_coder.op2_id_coder,
    "op1_pitman_yor": pitman_yor.op1_pitman_yor,
    "op6_repeated_substrings": repeated_substrings.op6_repeated_substrings,
    "op8_fuzzy_line_dedup": line_dedup.op8_fuzzy_line_dedup,
    "op5_ngram_perplexity": perplexity.op5_ngram_perplexity,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op9_best_two_fit": packing.op9_best_two_fit,
    "op10_quality_classifier": quality_classifier.op10_quality_classifier,
    "op3_ngram_jaccard_join": ngram_join.op3_ngram_jaccard_join,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
}

ORACLE_SQL = {
    "op11_secret_scan": secret_scan.OP11_SQL,
    "op12_slot_negatives": hard_negatives.OP12_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
}
