"""Queries and SQL of the training-data operators, for the driver's entry file."""

from __future__ import annotations

from paperloom.llm import (
    divergence, fingerprints, mixing, ngram_join, packing, perplexity, preferences, quality_rules, resampling, secret_scan, substring_dedup, suffix_dedup, token_store,
)

QUERIES = {
    "op1_token_store": token_store.query,
    "op2_secret_scan": secret_scan.query,
    "op3_mixing": mixing.query,
    "op4_quality_rules": quality_rules.query,
    "op5_substring_dedup": substring_dedup.query,
    "op6_perplexity": perplexity.query,
    "op7_preferences": preferences.query,
    "op8_fingerprints": fingerprints.query,
    "op9_packing": packing.query,
    "op10_ngram_join": ngram_join.query,
    "op11_resampling": resampling.query,
    "op12_suffix_dedup": suffix_dedup.query,
    "op13_divergence": divergence.query,
}

ORACLES: dict[str, str] = {"op2_secret_scan": secret_scan.SQL, "op7_preferences": preferences.SQL, "op10_ngram_join": ngram_join.SQL, "op11_resampling": resampling.SQL, "op12_suffix_dedup": suffix_dedup.SQL, "op13_divergence": divergence.SQL}
