"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, exact, importance, langid, lines, lm, mixing, pii, quality, simhash, suffix, toxicity, whitening


def queries() -> dict:
    return {
        "op1_quality_rules": quality.op1_quality_rules,
        "op2_simhash_neardup": simhash.op2_simhash_neardup,
        "op3_mixing": mixing.op3_mixing,
        "op4_line_dedup": lines.op4_line_dedup,
        "op5_suffix_dedup": suffix.op5_suffix_dedup,
        "op6_exact_dedup": exact.op6_exact_dedup,
        "op7_lm_score": lm.op7_lm_score,
        "op8_pii": pii.op8_pii,
        "op9_bpe": bpe.op9_bpe,
        "op10_language_id": langid.op10_language_id,
        "op11_toxicity": toxicity.op11_toxicity,
        "op12_importance": importance.op12_importance,
        "op13_whitening": whitening.op13_whitening,
    }


def oracle_sql() -> dict:
    return {
        "op1_quality_rules": quality.OP1_SQL,
        "op3_mixing": mixing.OP3_SQL,
        "op4_line_dedup": lines.OP4_SQL,
        "op6_exact_dedup": exact.OP6_SQL,
        "op12_importance": importance.OP12_SQL,
    }
