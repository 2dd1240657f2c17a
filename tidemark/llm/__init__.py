"""Operators for training-data pipelines: language ID, deduplication, search, toxicity,
packing, tokenisation, extraction and quality.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
