"""Scalar string helpers used to turn export fields into matchable values.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (the export's conventions): a modification is appended to the
# residues after the literal separator " + ", accessions are taken from
# ".../uniprot/<ACCESSION>" IRIs, epitope ids from ".../epitope/<digits>" IRIs,
# and an allele name is specific when it contains "*" or ":".
MODIFICATION_SEP = " + "
UNIPROT_PATTERN = r"uniprot/([A-Z0-9]+)"
EPITOPE_ID_PATTERN = r"epitope/(\d+)"
SPECIFIC_ALLELE_PATTERN = r"[*:]"
RESIDUES_ONLY_PATTERN = r"^[A-Z]+$"
# Unicode White_Space, the set a Unicode-aware regex "\s" matches (Java's
# "(?U)\s", Rust's "\s"): U+0009-U+000D, U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000. Deleting them with
# translate() equals regexp_replace(c, "(?U)\s+", "") without a regex engine.
UNICODE_WHITESPACE = "".join(
    chr(c) for c in [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def before_literal(col: Column | str, sep: str) -> Column:
    """Text before the first occurrence of the literal ``sep`` (whole text if absent)."""
    return F.substring_index(_c(col), sep, 1)


def strip_whitespace(col: Column | str) -> Column:
    """Remove every (Unicode) whitespace character."""
    return F.translate(_c(col), UNICODE_WHITESPACE, "")


def clean_sequence(col: Column | str) -> Column:
    """Residues of an export name: drop the ``" + MOD(...)"`` suffix, close up junction spaces."""
    return strip_whitespace(before_literal(col, MODIFICATION_SEP))


def extract_or_null(col: Column | str, pattern: str, group: int = 1) -> Column:
    """First regex group, or null when the pattern does not match (Spark returns '')."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def accession(cols: list[Column | str], pattern: str = UNIPROT_PATTERN) -> Column:
    """First column (in order) whose value yields an accession."""
    return F.coalesce(*[extract_or_null(c, pattern) for c in cols])


def epitope_id(col: Column | str) -> Column:
    """Numeric id from an epitope IRI as int; an id that overflows int raises
    (whatever the session's ANSI setting)."""
    digits = extract_or_null(col, EPITOPE_ID_PATTERN)
    overflow = F.when(digits.isNotNull(), F.raise_error(F.concat(F.lit("epitope id does not fit int: "), digits)))
    return F.coalesce(digits.try_cast("int"), overflow.cast("int"))


def flag_matches(col: Column | str, pattern: str = SPECIFIC_ALLELE_PATTERN) -> Column:
    """Regex-contains flag; null stays null."""
    return _c(col).rlike(pattern)


# Strict numeric text: the forms a strict parse accepts (Spark's own cast would
# also trim blanks and accept suffixes such as "1.5d" or hex floats).
# Optional sign and digits for integers; decimal or exponent
# notation and inf/infinity/nan (any case) for fractional numbers.
DOUBLE_TEXT = r"[+-]?(?:(?:[0-9]+(?:[.][0-9]*)?|[.][0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))"
_INTEGRAL = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}
_FRACTIONAL = {"float", "double", "real"}


def numeric_family(target: str) -> str | None:
    t = target.lower()
    return "integral" if t in _INTEGRAL else "fractional" if t in _FRACTIONAL else None


def numeric_text_ok(col: Column | str, target: str) -> Column | None:
    """Text guard for a strict numeric cast, to be combined with ``try_cast``
    (null for null input; ``None`` when ``target`` is not numeric).

    Integers: ``try_cast`` accepts ``[+-]?[0-9]+`` and tolerates only padding
    it trims (code points up to U+0020 and U+007F), so with a successful parse
    the text is plain exactly when it starts with a sign or digit and ends with
    a digit: two character tests, no regex. Fractional numbers: the full
    pattern, since Java's parser accepts more forms (suffixes, hex floats).
    """
    family = numeric_family(target)
    if family is None:
        return None
    c = _c(col)
    if family == "integral":
        first = F.ascii(c)
        last = F.ascii(F.substring(c, -1, 1))
        starts = ((first >= 48) & (first <= 57)) | (first == 43) | (first == 45)
        return starts & (last >= 48) & (last <= 57)
    return c.rlike(f"^{DOUBLE_TEXT}$")
