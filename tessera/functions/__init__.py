"""Scalar (per-row) column functions."""

from tessera.functions.naming import check_unique_slugs, compose_name, slug_expr, slugify
from tessera.functions.text import (
    accession,
    before_literal,
    clean_sequence,
    epitope_id,
    extract_or_null,
    flag_matches,
    strip_whitespace,
)

__all__ = [
    "accession",
    "before_literal",
    "check_unique_slugs",
    "clean_sequence",
    "compose_name",
    "epitope_id",
    "extract_or_null",
    "flag_matches",
    "slug_expr",
    "slugify",
    "strip_whitespace",
]
