"""The reduced epitope table over the export-shaped frame, and its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.reduce import extract_fields, reduce_to_grain
from tessera.plans.export_frame import EXPORT_FRAME_SQL, export_frame


def fields_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_fields(export_frame(spark, sf_dir))


def reduced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce_to_grain(fields_frame(spark, sf_dir))


GRAIN_SQL = "sequence, iedb_epitope_id, mhc_allele"


def _null_safe_on(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in GRAIN_SQL.split(", "))


def _modal_cte(name: str, col: str) -> str:
    # most frequent non-null value per grain; ties -> lowest value
    return f"""{name} AS (
  SELECT {GRAIN_SQL}, {col} FROM (
    SELECT {GRAIN_SQL}, {col},
           row_number() OVER (PARTITION BY {GRAIN_SQL} ORDER BY count(*) DESC, {col} ASC) AS rn
    FROM f WHERE {col} IS NOT NULL
    GROUP BY {GRAIN_SQL}, {col}
  ) WHERE rn = 1)"""


E_CTE = f"e AS ({EXPORT_FRAME_SQL})"

F_CTE = r"""f AS (
  SELECT regexp_replace(split_part(epitope_name, ' + ', 1), '\s+', '', 'g') AS sequence,
         nullif(regexp_extract(epitope_epitope_iri, 'epitope/(\d+)', 1), '')::int AS iedb_epitope_id,
         mhc_restriction_name AS mhc_allele,
         mhc_restriction_class AS mhc_class,
         coalesce(nullif(regexp_extract(epitope_molecule_parent_iri, 'uniprot/([A-Z0-9]+)', 1), ''),
                  nullif(regexp_extract(epitope_source_molecule_iri, 'uniprot/([A-Z0-9]+)', 1), '')) AS uniprot_id,
         epitope_source_molecule AS source_molecule,
         epitope_starting_position AS start_position,
         epitope_ending_position AS end_position,
         reference_pmid AS pmid,
         epitope_modified_residues AS modified_residues,
         epitope_modifications AS modifications
  FROM e WHERE epitope_object_type = 'Linear peptide')"""

G_CTE = f"""g AS (
  SELECT {GRAIN_SQL},
         min(mhc_class) AS mhc_class,
         list_sort(list(DISTINCT pmid) FILTER (WHERE pmid IS NOT NULL)) AS pmids,
         list_sort(list(DISTINCT modifications) FILTER (WHERE modifications IS NOT NULL)) AS modifications,
         list_sort(list(DISTINCT modified_residues) FILTER (WHERE modified_residues IS NOT NULL)) AS modified_residues,
         count(*) AS n_assays
  FROM f GROUP BY {GRAIN_SQL})"""

PAIR_CTE = f"""mp AS (
  SELECT {GRAIN_SQL}, start_position, end_position FROM (
    SELECT {GRAIN_SQL}, start_position, end_position,
           row_number() OVER (PARTITION BY {GRAIN_SQL}
                              ORDER BY count(*) DESC, start_position ASC NULLS LAST, end_position ASC NULLS LAST) AS rn
    FROM f GROUP BY {GRAIN_SQL}, start_position, end_position
  ) WHERE rn = 1)"""

R_CTE = f"""r AS (
  SELECT g.sequence,
         length(g.sequence)::smallint AS peptide_length,
         g.iedb_epitope_id, g.mhc_allele, g.mhc_class,
         regexp_matches(g.mhc_allele, '[*:]') AS allele_is_specific,
         uv.uniprot_id, sm.source_molecule,
         mp.start_position, mp.end_position,
         coalesce(g.pmids, []::INTEGER[]) AS pmids,
         len(coalesce(g.pmids, []::INTEGER[]))::int AS n_pmids,
         len(coalesce(g.modifications, []::VARCHAR[])) > 0 AS is_modified,
         coalesce(g.modifications, []::VARCHAR[]) AS modifications,
         coalesce(g.modified_residues, []::VARCHAR[]) AS modified_residues,
         g.n_assays
  FROM g
  LEFT JOIN uv ON {_null_safe_on('g', 'uv')}
  LEFT JOIN sm ON {_null_safe_on('g', 'sm')}
  LEFT JOIN mp ON g.sequence = mp.sequence AND g.iedb_epitope_id = mp.iedb_epitope_id AND g.mhc_allele = mp.mhc_allele)"""

REDUCED_CTES = ",\n".join(
    [E_CTE, F_CTE, G_CTE, _modal_cte("uv", "uniprot_id"), _modal_cte("sm", "source_molecule"), PAIR_CTE, R_CTE]
)


def with_reduced(body: str) -> str:
    """DuckDB SQL: ``body`` may read CTEs e (export frame), f (fields) and r (reduced table)."""
    return f"WITH {REDUCED_CTES}\n{body}"


def with_fields(body: str) -> str:
    return f"WITH {E_CTE},\n{F_CTE}\n{body}"


def with_export(body: str) -> str:
    return f"WITH {E_CTE}\n{body}"


REDUCED_FLAT_SELECT = """SELECT sequence, peptide_length, iedb_epitope_id, mhc_allele, mhc_class, allele_is_specific,
       uniprot_id, source_molecule, start_position, end_position,
       array_to_string(pmids, ',') AS pmids, n_pmids, is_modified,
       array_to_string(modifications, ',') AS modifications,
       array_to_string(modified_residues, ',') AS modified_residues, n_assays
FROM r"""
