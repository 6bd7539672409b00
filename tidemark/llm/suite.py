"""The registered queries of this package, with DuckDB SQL where it can express them."""

from __future__ import annotations

from tidemark.llm import (
    decontaminate,
    divergence,
    exact_dedup,
    html_text,
    near_dedup,
    packing,
    paragraph_dedup,
    pii,
    preference,
    quality,
    suffix_dedup,
    toxicity,
    whitening,
)

QUERIES = {
    "op1_decontaminate": decontaminate.op1,
    "op2_paragraph_dedup": paragraph_dedup.op2,
    "op3_pii": pii.op3,
    "op4_toxicity": toxicity.op4,
    "op5_preference": preference.op5,
    "op6_packing": packing.op6,
    "op7_near_dedup": near_dedup.op7,
    "op8_suffix_dedup": suffix_dedup.op8,
    "op9_quality": quality.op9,
    "op10_exact_dedup": exact_dedup.op10,
    "op11_divergence": divergence.op11,
    "op12_whitening": whitening.op12,
    "op13_html_text": html_text.op13,
}

SQL = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op5_preference": preference.OP5_SQL,
    "op7_near_dedup": near_dedup.OP7_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op11_divergence": divergence.OP11_SQL,
}
