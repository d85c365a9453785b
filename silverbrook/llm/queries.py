"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from silverbrook.llm import (
    alignment,
    byte_bpe,
    byte_cnn,
    html_text,
    maxent_lm,
    merkle,
    mixing,
    multi_index,
    near_dedup,
    quality_rules,
    secret_scan,
    token_counts,
    token_files,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_maxent_lm": maxent_lm.op4_maxent_lm,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_html_text": html_text.op6_html_text,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_multi_index": multi_index.op8_multi_index,
    "op9_byte_cnn": byte_cnn.op9_byte_cnn,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_merkle": merkle.op11_merkle,
    "op12_token_files": token_files.op12_token_files,
    "op13_alignment": alignment.op13_alignment,
}

SQL: dict[str, str] = {"op11_merkle": merkle.SQL}
