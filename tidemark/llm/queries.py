"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from tidemark.llm import (bpe, exact_dedup, extraction, language, near_dedup, packing, quality, quality_rules, resampling,
                          spelling, token_store, topk, toxicity)

MODULES = (language, near_dedup, exact_dedup, topk, bpe, toxicity, packing, token_store, extraction, quality,
           quality_rules, resampling, spelling)
QUERIES = {name: fn for module in MODULES for name, fn in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in getattr(module, "ORACLE", {}).items()}
