"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib

#: module, query function, name of the module's SQL text (None: SQL cannot express it)
OPS = [
    ("topk_search", "op1_exact_topk_search", "ORACLE_SQL"),
    ("chat_format", "op2_chat_formatting", "ORACLE_SQL"),
    ("quality", "op3_quality_classifier", None),
    ("token_counts", "op4_token_counts", None),
    ("minhash_dedup", "op5_minhash_near_dedup", None),
    ("suffix_dedup", "op6_suffix_array_dedup", None),
    ("toxicity", "op7_toxicity", None),
    ("line_dedup", "op8_line_dedup", "ORACLE_SQL"),
    ("mixing", "op9_mixing", "ORACLE_SQL"),
    ("decontaminate", "op10_benchmark_decontamination", "ORACLE_SQL"),
    ("simhash_dedup", "op11_simhash_near_dedup", None),
    ("source_audit", "op12_source_divergence_audit", "ORACLE_SQL"),
    ("clustering", "op13_centroid_clustering", "ORACLE_SQL"),
]


def queries() -> dict:
    return {fn: getattr(importlib.import_module(f"netquill.llm.{mod}"), fn) for mod, fn, _ in OPS}


def oracle_sql() -> dict[str, str]:
    return {fn: getattr(importlib.import_module(f"netquill.llm.{mod}"), sql) for mod, fn, sql in OPS if sql}
