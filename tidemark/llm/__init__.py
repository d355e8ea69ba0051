"""Operators of a training-data pipeline, one module each.

Nothing outside this folder, ``corpus_pipeline.py`` and the entry module
imports it.
"""
