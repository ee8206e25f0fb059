"""Queries of this subpackage and, where SQL can express them, the SQL for the same rows."""

from __future__ import annotations

from . import exact_dedup, html_diff, mixing, packing, quality_rules, simhash, suffix_dedup, toxicity, unit_dedup, wavelet


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_quality_rules": quality_rules.op4_quality_rules,
        "op5_unit_dedup": unit_dedup.op5_unit_dedup,
        "op6_packing": packing.op6_packing,
        "op7_simhash": simhash.op7_simhash,
        "op8_mixing": mixing.op8_mixing,
        "op9_html_diff": html_diff.op9_html_diff,
        "op10_wavelet": wavelet.op10_wavelet,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": exact_dedup.SQL, "op5_unit_dedup": unit_dedup.SQL}
