"""Structured Streaming variants of the import."""
