"""Operators of a training-data pipeline: deduplication, tokens, quality, packing, personal data."""
