"""Operators of a training-data pipeline: fingerprints, tokens, shards, dedup, filters.

Nothing else in the library imports this package.
"""
