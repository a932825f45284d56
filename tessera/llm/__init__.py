"""Operators for large-scale training-data preparation.

Nothing else in ``tessera`` imports this subpackage; ``queries`` registers one
query per operator and the five-stage pipeline of ``corpus_pipeline.py``.
"""
