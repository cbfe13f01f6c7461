"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from recordsmith.llm.align import op11_token_alignment
from recordsmith.llm.bpe import op1_bpe_roundtrip
from recordsmith.llm.chat_format import OP4_SQL, op4_chat_format
from recordsmith.llm.decontaminate import op7_decontaminate
from recordsmith.llm.lines import OP3_SQL, op3_line_dedup
from recordsmith.llm.lm_score import op5_lm_score
from recordsmith.llm.minhash import op2_minhash_dedup
from recordsmith.llm.pii import op12_pii_sanitise
from recordsmith.llm.quality import OP9_SQL, op9_quality_rules
from recordsmith.llm.substrings import op8_substring_dedup
from recordsmith.llm.token_counts import op6_token_counts
from recordsmith.llm.toxicity import op10_toxicity
from recordsmith.llm.whitening import op13_embedding_whitening


def queries() -> dict:
    return {
        "op1_bpe_roundtrip": op1_bpe_roundtrip,
        "op2_minhash_dedup": op2_minhash_dedup,
        "op3_line_dedup": op3_line_dedup,
        "op4_chat_format": op4_chat_format,
        "op5_lm_score": op5_lm_score,
        "op6_token_counts": op6_token_counts,
        "op7_decontaminate": op7_decontaminate,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_quality_rules": op9_quality_rules,
        "op10_toxicity": op10_toxicity,
        "op11_token_alignment": op11_token_alignment,
        "op12_pii_sanitise": op12_pii_sanitise,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": OP3_SQL,
        "op4_chat_format": OP4_SQL,
        "op9_quality_rules": OP9_SQL,
    }
