"""Operators of a large-scale training-data pipeline (numbered 1-10).

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
