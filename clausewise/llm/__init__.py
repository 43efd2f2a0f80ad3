"""Operators for preparing large text corpora for model training.

Nothing outside this package imports it.  ``queries.py`` registers the contract queries, with their
DuckDB counterparts where SQL can express them.
"""
