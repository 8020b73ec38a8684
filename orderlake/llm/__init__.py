"""Operators of a training-data pipeline: cleaning, deduplication, mixing, tokens, scores and archives.

Nothing else in the library imports this package. Registered queries are in ``queries``.
"""
