"""Operators for preparing training text: scoring, cleaning, deduplication, mixing and formatting.

Nothing outside this subpackage imports it, apart from the guarded import in the driver entry and `corpus_pipeline`.
"""
