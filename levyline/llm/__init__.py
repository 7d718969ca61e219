"""Operators for large training-text corpora and their pipeline.

Nothing outside this subpackage imports it. Queries and oracle SQL: ``queries.py``.
"""
