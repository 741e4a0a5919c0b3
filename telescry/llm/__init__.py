"""Operators for training data: cleaning, deduplication, extraction, privacy, tokens, mixing, search, quality and repair.

Nothing outside this package imports it.  ``queries`` registers one query per operator.
"""
