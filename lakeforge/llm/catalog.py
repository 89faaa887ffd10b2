"""Registered queries of the operators, one per operator, and their SQL."""

from __future__ import annotations

from lakeforge.llm import exact_dedup, fingerprints, hard_negatives, license_scan, manifest, maxent_lm, nearest, ngram_join, packing, piece_encoding, substring_dedup, token_counts, toxicity

QUERIES = {
    "op1_best_fit_packing": packing.query,
    "op2_suffix_array_dedup": substring_dedup.query,
    "op3_sentencepiece": piece_encoding.query,
    "op4_token_counts": token_counts.query,
    "op5_maxent_lm": maxent_lm.query,
    "op6_license_scan": license_scan.query,
    "op7_fingerprints": fingerprints.query,
    "op8_toxicity": toxicity.query,
    "op9_exact_dedup": exact_dedup.query,
    "op10_ngram_join": ngram_join.query,
    "op11_nearest_neighbours": nearest.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_merkle_manifest": manifest.query,
}

ORACLE = {
    "op6_license_scan": license_scan.ORACLE_SQL,
    "op9_exact_dedup": exact_dedup.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
}
