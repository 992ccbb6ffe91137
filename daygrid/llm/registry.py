"""The queries of this package and their SQL oracles."""

from __future__ import annotations

from daygrid.llm import alignment, decontaminate, html, lloyd, lm, mixing, passages, pii, quality, secrets, simhash, suffix, toxicity
from daygrid.llm.oracle import ORACLE

QUERIES = {
    "op1_html_extraction": html.op1_html_extraction,
    "op2_mixing": mixing.op2_mixing,
    "op3_lm_scoring": lm.op3_lm_scoring,
    "op4_suffix_array_dedup": suffix.op4_suffix_array_dedup,
    "op5_substring_dedup": passages.op5_substring_dedup,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_pii_surrogates": pii.op7_pii_surrogates,
    "op8_secret_scans": secrets.op8_secret_scans,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_cross_tokenizer_alignment": alignment.op11_cross_tokenizer_alignment,
    "op12_centroid_clustering": lloyd.op12_centroid_clustering,
    "op13_toxicity": toxicity.op13_toxicity,
}
__all__ = ["ORACLE", "QUERIES"]
