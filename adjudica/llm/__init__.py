"""Operators and a pipeline for preparing large text corpora.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
