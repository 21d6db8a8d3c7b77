"""Operators for preparing training corpora, one module each.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
