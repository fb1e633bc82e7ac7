"""The export at its published width: 112 columns, of which 15 are numbers.

The 14 columns of :mod:`tessera.plans.export_frame`, the other typed columns of the export from fixed arithmetic over
lineitem, and text columns (one of them with quoted newlines) up to the width. ``WIDE_EXPORT_SQL`` is the same frame
in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.export_frame import EXPORT_FRAME_SQL, export_frame, read_table
from tessera.sources.sharded_csv import EXPORT_TYPES

WIDTH = 112
# E's own columns, in its order
EXPORT_COLUMNS = (
    "epitope_name", "epitope_epitope_iri", "mhc_restriction_name", "mhc_restriction_class", "epitope_molecule_parent_iri",
    "epitope_source_molecule_iri", "epitope_source_molecule", "epitope_starting_position", "epitope_ending_position",
    "reference_pmid", "reference_date", "epitope_modifications", "epitope_modified_residues", "epitope_object_type")
# typed columns that E lacks: an offset and, every so many rows, no value
_TYPED = [c for c in EXPORT_TYPES if c not in EXPORT_COLUMNS]
_TEXT = [f"assay_note_{n}" for n in range(WIDTH - len(EXPORT_COLUMNS) - len(_TYPED))]


def wide_columns() -> list[str]:
    return [*EXPORT_COLUMNS, *_TYPED, *_TEXT]


def _typed_values() -> list[tuple[str, str]]:
    """Name and value of each further typed column, in words that both engines share."""
    out = []
    for n, c in enumerate(_TYPED):
        # whole numbers past 16 bits for int, halves for double
        value = f"reference_pmid * {97 + n} + {40_000 + n}"
        value = f"CAST({value} AS {EXPORT_TYPES[c]})" if EXPORT_TYPES[c] != "double" else f"CAST({value} AS double) + 0.5"
        out.append((c, f"CASE WHEN reference_pmid % {5 + n} <> 0 THEN {value} END"))
    return out


def _text_values(newline: str) -> list[tuple[str, str]]:
    out = [(_TEXT[0], f"concat(epitope_source_molecule, ', \"a\"', {newline}, epitope_object_type)")]
    out += [(c, f"concat(epitope_source_molecule, ' text {n}')") for n, c in enumerate(_TEXT) if n]
    return out


def wide_values() -> list[Column]:
    """The columns of :func:`wide_columns`, made from those of E."""
    return [*[F.col(c) for c in EXPORT_COLUMNS], *[F.expr(value).alias(c) for c, value in _typed_values() + _text_values("chr(10)")]]


def wide_export_frame(spark: SparkSession, sf_dir: str, task_rows: int | None = None) -> DataFrame:
    """The frame at its full width; with ``task_rows``, its rows are dealt into tasks of about so many before they widen."""
    e = export_frame(spark, sf_dir)
    if task_rows:
        # as many as lineitem has, from the footers
        e = e.repartition(read_table(spark, sf_dir, "lineitem").count() // task_rows + 1)
    return e.select(*wide_values())


WIDE_EXPORT_SQL = (f"SELECT {', '.join(EXPORT_COLUMNS)}, "
                   + ", ".join(f"{value} AS {c}" for c, value in _typed_values() + _text_values("chr(10)"))
                   + f" FROM ({EXPORT_FRAME_SQL})")
