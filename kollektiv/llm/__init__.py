"""Operators for preparing training corpora.

Nothing outside this package (and ``corpus_pipeline.py``) imports it; it may
use the library's general helpers (sessions, staging).
"""
