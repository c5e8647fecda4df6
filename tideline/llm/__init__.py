"""Operators of a training-data pipeline: dedup, extraction, tokens, filters, scoring, archives.

Nothing else in the package imports this subpackage.
"""
