"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

import corpus_pipeline
from tideline.llm import bpe, decontamination, exact_dedup, hard_negatives, html_extraction, near_dedup, quality_rules, substring_dedup, token_counts, tokenizer_alignment, toxicity, url_filters, warc

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_html_extraction": html_extraction.op5_html_extraction,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_bpe": bpe.op7_bpe,
    "op8_url_filters": url_filters.op8_url_filters,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "pipeline": corpus_pipeline.run,
    "op9_warc": warc.op9_warc,
    "op11_exact_dedup": exact_dedup.op11_exact_dedup,
    "op12_tokenizer_alignment": tokenizer_alignment.op12_tokenizer_alignment,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLES = {"op3_substring_dedup": substring_dedup.ORACLE, "op2_quality_rules": quality_rules.ORACLE, "op6_decontamination": decontamination.ORACLE, "op8_url_filters": url_filters.ORACLE, "op9_warc": warc.ORACLE, "op11_exact_dedup": exact_dedup.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
