"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from bindery.llm import ann, bpe, byte_bpe, exact_dedup, fim, html_text, lm_scoring, manifest, packing, pii, preference, quality, simhash


def queries() -> dict:
    return {
        "op1_lm_scoring": lm_scoring.op1_lm_scoring,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_simhash": simhash.op3_simhash,
        "op4_ann": ann.op4_ann,
        "op5_packing": packing.op5_packing,
        "op6_pii": pii.op6_pii,
        "op7_html": html_text.op7_html,
        "op8_preference": preference.op8_preference,
        "op9_quality": quality.op9_quality,
        "op10_bpe": bpe.op10_bpe,
        "op11_merkle": manifest.op11_merkle,
        "op12_fim": fim.op12_fim,
        "op13_byte_bpe": byte_bpe.op13_byte_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.ORACLE, "op8_preference": preference.ORACLE, "op11_merkle": manifest.ORACLE, "op12_fim": fim.ORACLE}
