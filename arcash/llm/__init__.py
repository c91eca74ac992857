"""Operators of a training-data pipeline: classifiers, near-duplicate search, archives,
token counts, decontamination, licence scan, line de-duplication, vector search, packing.

Nothing outside this subpackage, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
