"""Registered queries of the training-data operators, and the SQL where SQL can say them."""

from __future__ import annotations

from tandem.llm import (decontaminate, language, licenses, mixing, partenum, phrases, pivots, quality, scoring, sharding,
                        spelling, substrings, token_files)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_ngram_jaccard_join": partenum.op3_ngram_jaccard_join,
    "op4_pivot_near_vectors": pivots.op4_pivot_near_vectors,
    "op5_language_id": language.op5_language_id,
    "op6_token_files": token_files.op6_token_files,
    "op7_quality_cnn": quality.op7_quality_cnn,
    "op8_poisson_mixing": mixing.op8_poisson_mixing,
    "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    "op10_sharding": sharding.op10_sharding,
    "op11_phrase_mining": phrases.op11_phrase_mining,
    "op12_lm_scoring": scoring.op12_lm_scoring,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLES = {
    "op8_poisson_mixing": mixing.OP8_SQL,
    "op11_phrase_mining": phrases.OP11_SQL,
}
