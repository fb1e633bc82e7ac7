"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (through the export-shaped frame where the
operator expects an export) and returns a DataFrame; list columns are joined
into strings so value hashes do not depend on array encodings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.naming import slug_expr
from tessera.functions.text import clean_sequence
from tessera.operators.aggregates import distinct_sorted_list, modal_value
from tessera.operators.catalog import audit_casts, infer_types
from tessera.operators.fuzzy_index import write_fuzzy_index
from tessera.operators.quality import check_expected, quality_report
from tessera.operators.ranking import best_per_key, best_row, exact_lookup, lookup
from tessera.operators.reduce import GRAIN, heavy_grains, modal_pair_per_grain, reduce_to_grain
from tessera.operators.reports import class_report, reduced_summary
from tessera.operators.similarity import fuzzy_join, fuzzy_sweep
from tessera.plans.epitope_table import (
    REDUCED_FLAT_SELECT,
    fields_frame,
    reduced_table,
    with_export,
    with_fields,
    with_reduced,
)
from tessera.plans.export_frame import export_frame, read_table
from tessera.plans.wide_export import WIDE_EXPORT_SQL, wide_columns, wide_export_frame
from tessera.session import scratch_path
from tessera.sinks.writers import flatten_lists, write_csv_report, write_parquet, write_reduced_table
from tessera.sources.parquet import sql_over_files
from tessera.sources.sharded_csv import NULL_SENTINEL

# Fixed query parameters (chosen once for the driver data: ship years run 1995-2001).
REPORT_CLASS = "I"
REPORT_MIN_YEAR = 1998
REPORT_TOP_N = 5
LOOKUP = "SMALLRING"
SWEEP_QUERY = "ERDWIDGET"  # two letters of a part name swapped
SWEEP_LENGTH = 9
MAX_DISTANCE = 2


def best_order():
    return [F.col("n_assays").desc(), F.col("iedb_epitope_id").asc_nulls_last(), F.col("mhc_allele").asc_nulls_last()]


BEST_ORDER_SQL = "n_assays DESC, iedb_epitope_id ASC NULLS LAST, mhc_allele ASC NULLS LAST"
AUDIT_CASTS = {
    "p_partkey": "int",
    "p_brand": "int",
    "p_size": "smallint",
    "p_retailprice": "double",
    "p_type": "double",
}


# ---------------------------------------------------------------- Spark side

def q_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_report(export_frame(spark, sf_dir), REPORT_CLASS, REPORT_MIN_YEAR, REPORT_TOP_N)


CLASS_REPORT_SQL = f"""SELECT mhc_restriction_name, count(*) AS assays,
       round(avg(epitope_ending_position - epitope_starting_position + 1), 1) AS mean_len
FROM {{table}} WHERE mhc_restriction_class = '{REPORT_CLASS}' AND reference_date >= {REPORT_MIN_YEAR}
GROUP BY mhc_restriction_name
ORDER BY assays DESC, mhc_restriction_name ASC NULLS LAST
LIMIT {REPORT_TOP_N}"""


def q_class_report_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the same report as SQL over a written Parquet table, by its path
    path = scratch_path(spark, "export-frame")
    write_parquet(export_frame(spark, sf_dir), path)
    return sql_over_files(spark, CLASS_REPORT_SQL.format(table="{table}"), table=path)


def q_extract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields_frame(spark, sf_dir)


def q_modal_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modal_pair_per_grain(fields_frame(spark, sf_dir))


def q_modal_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fields_frame(spark, sf_dir)
    return f.groupBy(*GRAIN).agg(
        modal_value("uniprot_id").alias("uniprot_id"),
        modal_value("source_molecule").alias("source_molecule"),
    )


def q_distinct_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fields_frame(spark, sf_dir)
    g = f.groupBy(*GRAIN).agg(
        distinct_sorted_list("pmid").alias("pmids"),
        distinct_sorted_list("modifications").alias("modifications"),
        distinct_sorted_list("modified_residues").alias("modified_residues"),
    )
    g = g.withColumn("n_pmids", F.size("pmids").cast("int"))
    return flatten_lists(g)


def q_reduced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_lists(reduced_table(spark, sf_dir))


def q_reduced_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduced_summary(reduced_table(spark, sf_dir))


def q_best_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reduced_table(spark, sf_dir).where(F.col("allele_is_specific"))
    best = best_per_key(r, ["sequence"], best_order())
    return flatten_lists(best)


KNOWN_COLUMNS = ("sequence", "iedb_epitope_id", "mhc_allele", "uniprot_id", "start_position", "end_position",
                 "pmids", "n_pmids", "modifications", "modified_residues", "n_assays")


def q_known_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # membership against a keys table (every part name, cleaned like a sequence)
    keys = read_table(spark, sf_dir, "part").select(clean_sequence(F.upper("p_name")).alias("sequence"))
    r = lookup(reduced_table(spark, sf_dir), "sequence", keys).where(F.col("allele_is_specific"))
    best = best_per_key(r, ["sequence"], best_order())
    return flatten_lists(best).select(*KNOWN_COLUMNS)


def q_known_rows_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the same rows written as an ordered CSV report and read back as text
    path = scratch_path(spark, "known-rows")
    write_csv_report(q_known_rows(spark, sf_dir), path, order_by=[F.col("sequence")])
    schema = ", ".join(f"{c} string" for c in KNOWN_COLUMNS)
    return spark.read.schema(schema).options(header=True, escape='"', nullValue=NULL_SENTINEL).csv(path)


def q_best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_lists(best_row(reduced_table(spark, sf_dir), "sequence", LOOKUP, best_order()))


def q_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # what every part name's best row should hold, against what it holds
    expected = read_table(spark, sf_dir, "part").select(
        clean_sequence(F.upper("p_name")).alias("sequence"), F.lit("P1").alias("uniprot_id"), F.lit(1).alias("start_position"),
    ).distinct()
    return check_expected(reduced_table(spark, sf_dir), expected, "sequence", best_order(), ["uniprot_id", "start_position"],
                          where=F.col("allele_is_specific"))


def q_exact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_lists(exact_lookup(reduced_table(spark, sf_dir), "sequence", LOOKUP))


def q_sorted_table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the reduced table written range-sorted by grain (zstd-9) under the shared
    # scratch folder, then an equality lookup that prunes on row-group statistics
    written = write_reduced_table(reduced_table(spark, sf_dir), scratch_path(spark, "reduced-table"))
    return flatten_lists(exact_lookup(written, "sequence", LOOKUP))


HEAVY_EXAMPLE = 24  # so that the driver tables have grains on both paths; HEAVY_ROWS is the real bound


def q_reduced_two_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    # grains above a number of rows are reduced by counting their values
    f = fields_frame(spark, sf_dir)
    path = scratch_path(spark, "heavy-grains")
    heavy_grains(f, rows=HEAVY_EXAMPLE).write.parquet(path)
    return flatten_lists(reduce_to_grain(f, heavy=spark.read.parquet(path)))


LOOKUP_ID, LOOKUP_ALLELE = 7, "HLA-A*02:01"


def q_bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # lookups by columns that the table is not sorted by
    table = write_reduced_table(reduced_table(spark, sf_dir), scratch_path(spark, "reduced-bloom"),
                                bloom={"iedb_epitope_id": 100_000, "mhc_allele": 10_000})
    by_id = exact_lookup(table, "iedb_epitope_id", LOOKUP_ID)
    return flatten_lists(exact_lookup(by_id, "mhc_allele", LOOKUP_ALLELE))


#: Rows of a task that infers types, about: 112 values each.
TYPED_ROWS = 50_000


def q_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every column of the wide export as text, back to its type
    e = wide_export_frame(spark, sf_dir, TYPED_ROWS)
    return infer_types(e.select(*[F.col(c).cast("string").alias(c) for c in e.columns]))


def q_fuzzy_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reduced_table(spark, sf_dir).where(F.col("peptide_length") == SWEEP_LENGTH)
    hits = fuzzy_sweep(r, "sequence", SWEEP_QUERY, MAX_DISTANCE)
    return hits.select("sequence", "mhc_allele", "uniprot_id", "source_molecule", "distance")


SWEEP_SQL = f"""SELECT sequence, mhc_allele, uniprot_id, source_molecule,
       damerau_levenshtein(sequence, '{SWEEP_QUERY}') AS distance
FROM read_parquet('{{path}}')
WHERE peptide_length = {SWEEP_LENGTH}
  AND damerau_levenshtein(sequence, '{SWEEP_QUERY}') <= {MAX_DISTANCE};"""


def q_fuzzy_sweep_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the same sweep as a SQL statement over the written table, by its path
    path = scratch_path(spark, "reduced-for-sql")
    write_parquet(reduced_table(spark, sf_dir), path)
    return sql_over_files(spark, SWEEP_SQL.format(path=path))


FUZZY_COLUMNS = ("query_sequence", "sequence", "iedb_epitope_id", "mhc_allele", "n_assays", "distance")


def _queries_and_targets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # the targets are used twice, so the reduction is written once
    path = scratch_path(spark, "fuzzy-targets")
    columns = ("sequence", "iedb_epitope_id", "mhc_allele", "mhc_class", "n_assays")
    write_parquet(reduced_table(spark, sf_dir).select(*columns), path, level=None)
    return read_table(spark, sf_dir, "part").select(clean_sequence(F.upper("p_name")).alias("query")), spark.read.parquet(path)


def q_fuzzy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, r = _queries_and_targets(spark, sf_dir)
    return fuzzy_join(queries, "query", r, "sequence", MAX_DISTANCE).select(*FUZZY_COLUMNS)


def q_fuzzy_join_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # an index of the class I sequences, extended by the others, then queried
    queries, r = _queries_and_targets(spark, sf_dir)
    index = write_fuzzy_index(r.where(F.col("mhc_class") == REPORT_CLASS), "sequence", MAX_DISTANCE,
                              scratch_path(spark, "fuzzy-index"), n_buckets=8)
    index.add(r, "sequence")
    return index.join(queries, "query", r, "sequence").select(*FUZZY_COLUMNS)


def q_quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(reduced_table(spark, sf_dir))


def q_slug_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    name = F.concat(F.col("p_brand"), F.lit(" - "), F.col("p_type"), F.lit(" (%)"))
    return p.select("p_partkey", name.alias("name"), slug_expr(name).alias("slug"))


def q_cast_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    as_text = p.select(*[F.col(c).cast("string").alias(c) for c in AUDIT_CASTS])
    return audit_casts(as_text, AUDIT_CASTS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "class_report": q_class_report,
    "class_report_sql": q_class_report_sql,
    "extract_fields": q_extract_fields,
    "modal_pair": q_modal_pair,
    "modal_value": q_modal_value,
    "distinct_lists": q_distinct_lists,
    "reduced_table": q_reduced_table,
    "reduced_summary": q_reduced_summary,
    "best_per_key": q_best_per_key,
    "known_rows": q_known_rows,
    "known_rows_report": q_known_rows_report,
    "best_row": q_best_row,
    "expectations": q_expectations,
    "exact_lookup": q_exact_lookup,
    "sorted_table_lookup": q_sorted_table_lookup,
    "reduced_two_paths": q_reduced_two_paths,
    "bloom_lookup": q_bloom_lookup,
    "inferred_types": q_inferred_types,
    "fuzzy_sweep": q_fuzzy_sweep,
    "fuzzy_sweep_sql": q_fuzzy_sweep_sql,
    "fuzzy_join": q_fuzzy_join,
    "fuzzy_join_indexed": q_fuzzy_join_indexed,
    "quality_checks": q_quality_checks,
    "slug_values": q_slug_values,
    "cast_audit": q_cast_audit,
}


# ---------------------------------------------------------------- DuckDB side

def _slug_sql(x: str) -> str:
    return f"lower(trim(regexp_replace(replace({x}, '%', 'percent'), '[^0-9a-zA-Z]+', '_', 'g'), '_'))"


def _audit_sql() -> str:
    duck_types = {"int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE"}
    parts = []
    for c, t in AUDIT_CASTS.items():
        x = f"{c}::varchar"
        tc = f"TRY_CAST({x} AS {duck_types[t]})"
        parts.append(
            f"SELECT '{c}' AS column_name, '{t}' AS target_type, count(*) AS n_rows, "
            f"count({x}) AS n_non_null, count(*) FILTER (WHERE {x} IS NOT NULL AND {tc} IS NULL) AS n_unparsable, "
            f"min({tc})::double AS min_value, max({tc})::double AS max_value FROM part"
        )
    return "\nUNION ALL\n".join(parts)


def _types_sql() -> str:
    """The narrowest type of every column of the wide export, from its values as text."""
    parts = []
    for c in wide_columns():
        x = f'"{c}"::varchar'
        whole = f"regexp_full_match({x}, '[+-]?(0|[1-9][0-9]*)')"
        number = f"CASE WHEN {whole} THEN try_cast({x} AS bigint) END"
        plain = f"regexp_full_match({x}, '[+-]?([0-9]|[1-9][0-9]*)(\\.[0-9]*)?([eE][+-]?[0-9]+)?')"
        rank = (f"CASE WHEN {x} IS NULL THEN 0 WHEN {number} BETWEEN -32768 AND 32767 THEN 1 "
                f"WHEN {number} BETWEEN -2147483648 AND 2147483647 THEN 2 WHEN {number} IS NOT NULL THEN 3 "
                f"WHEN NOT {whole} AND {plain} THEN 4 ELSE 5 END")
        parts.append(f"SELECT '{c}' AS column_name, max({rank}) AS rank, count(*) AS n_rows, count({x}) AS n_non_null, "
                     f"min(try_cast({x} AS double)) AS lo, max(try_cast({x} AS double)) AS hi FROM w")
    union = "\nUNION ALL\n".join(parts)
    return f"""WITH w AS ({WIDE_EXPORT_SQL}), t AS ({union})
SELECT column_name, ['null', 'smallint', 'int', 'bigint', 'double', 'string'][rank + 1] AS type, n_rows, n_non_null,
       CASE WHEN rank BETWEEN 1 AND 4 THEN lo END AS min_value, CASE WHEN rank BETWEEN 1 AND 4 THEN hi END AS max_value FROM t"""


_PART_SEQUENCE = "regexp_replace(split_part(upper(p_name), ' + ', 1), '\\s+', '', 'g')"

_KNOWN_SQL = f"""sequence, iedb_epitope_id, mhc_allele, uniprot_id, start_position, end_position,
       array_to_string(pmids, ',') AS pmids, n_pmids, array_to_string(modifications, ',') AS modifications,
       array_to_string(modified_residues, ',') AS modified_residues, n_assays
FROM (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY {BEST_ORDER_SQL}) AS rk
      FROM r WHERE allele_is_specific AND sequence IN (SELECT {_PART_SEQUENCE} FROM part))
WHERE rk = 1"""

ORACLES: dict[str, str] = {
    "class_report": with_export(CLASS_REPORT_SQL.format(table="e")),
    "class_report_sql": with_export(CLASS_REPORT_SQL.format(table="e")),
    "extract_fields": with_fields("SELECT * FROM f"),
    "modal_pair": with_reduced(
        """SELECT g.sequence, g.iedb_epitope_id, g.mhc_allele, mp.start_position, mp.end_position
FROM g LEFT JOIN mp ON g.sequence = mp.sequence AND g.iedb_epitope_id = mp.iedb_epitope_id
                   AND g.mhc_allele = mp.mhc_allele"""
    ),
    "modal_value": with_reduced("SELECT sequence, iedb_epitope_id, mhc_allele, uniprot_id, source_molecule FROM r"),
    "distinct_lists": with_reduced(
        """SELECT sequence, iedb_epitope_id, mhc_allele, array_to_string(pmids, ',') AS pmids,
       array_to_string(modifications, ',') AS modifications,
       array_to_string(modified_residues, ',') AS modified_residues, n_pmids FROM r"""
    ),
    "reduced_table": with_reduced(REDUCED_FLAT_SELECT),
    "reduced_summary": with_reduced(
        """SELECT count(*) AS rows,
       (SELECT count(*) FROM (SELECT DISTINCT sequence FROM r)) AS distinct_sequences,
       count(uniprot_id) AS with_uniprot,
       round(100.0 * count(uniprot_id) / nullif(count(*), 0), 1) AS pct_with_uniprot,
       count(*) FILTER (WHERE is_modified) AS modified,
       count(*) FILTER (WHERE allele_is_specific) AS specific_allele_rows
FROM r"""
    ),
    "best_per_key": with_reduced(
        REDUCED_FLAT_SELECT.replace("FROM r", "FROM (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY "
                                    + BEST_ORDER_SQL + ") AS rk FROM r WHERE allele_is_specific) WHERE rk = 1")
    ),
    "known_rows": with_reduced("SELECT " + _KNOWN_SQL),
    "known_rows_report": with_reduced("SELECT COLUMNS(*)::varchar FROM (SELECT " + _KNOWN_SQL + ")"),
    "best_row": with_reduced(
        REDUCED_FLAT_SELECT + f"\nWHERE sequence = '{LOOKUP}' ORDER BY {BEST_ORDER_SQL} LIMIT 1"),
    "expectations": with_reduced(
        f"""SELECT x.sequence, 'P1' AS expected_uniprot_id, 1 AS expected_start_position, b.uniprot_id, b.start_position,
       b.sequence IS NOT NULL AS found
FROM (SELECT DISTINCT {_PART_SEQUENCE} AS sequence FROM part) x
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY {BEST_ORDER_SQL}) AS rk
                          FROM r WHERE allele_is_specific) WHERE rk = 1) b ON x.sequence = b.sequence
WHERE b.sequence IS NULL OR b.uniprot_id IS DISTINCT FROM 'P1' OR b.start_position IS DISTINCT FROM 1"""
    ),
    "exact_lookup": with_reduced(REDUCED_FLAT_SELECT + f"\nWHERE sequence = '{LOOKUP}'"),
    "sorted_table_lookup": with_reduced(REDUCED_FLAT_SELECT + f"\nWHERE sequence = '{LOOKUP}'"),
    "reduced_two_paths": with_reduced(REDUCED_FLAT_SELECT),
    "bloom_lookup": with_reduced(
        REDUCED_FLAT_SELECT + f"\nWHERE iedb_epitope_id = {LOOKUP_ID} AND mhc_allele = '{LOOKUP_ALLELE}'"),
    "inferred_types": _types_sql(),
    "fuzzy_sweep": with_reduced(
        f"""SELECT sequence, mhc_allele, uniprot_id, source_molecule,
       damerau_levenshtein(sequence, '{SWEEP_QUERY}')::int AS distance
FROM r WHERE peptide_length = {SWEEP_LENGTH} AND damerau_levenshtein(sequence, '{SWEEP_QUERY}') <= {MAX_DISTANCE}"""
    ),
    "fuzzy_join": with_reduced(
        f"""SELECT q.query AS query_sequence, r.sequence, r.iedb_epitope_id, r.mhc_allele, r.n_assays,
       damerau_levenshtein(q.query, r.sequence)::int AS distance
FROM (SELECT DISTINCT regexp_replace(split_part(upper(p_name), ' + ', 1), '\\s+', '', 'g') AS query FROM part) q
JOIN r ON abs(length(q.query) - length(r.sequence)) <= {MAX_DISTANCE}
WHERE damerau_levenshtein(q.query, r.sequence) <= {MAX_DISTANCE}"""
    ),
    "fuzzy_sweep_sql": with_reduced(
        f"""SELECT sequence, mhc_allele, uniprot_id, source_molecule,
       damerau_levenshtein(sequence, '{SWEEP_QUERY}')::int AS distance
FROM r WHERE peptide_length = {SWEEP_LENGTH} AND damerau_levenshtein(sequence, '{SWEEP_QUERY}') <= {MAX_DISTANCE}"""
    ),
    "quality_checks": with_reduced(
        """SELECT 'grain_unique' AS "check", sum(n)::bigint AS n_rows, coalesce(sum(n - 1) FILTER (WHERE n > 1), 0)::bigint AS n_violations
FROM (SELECT count(*) AS n FROM r GROUP BY sequence, iedb_epitope_id, mhc_allele)
UNION ALL
SELECT 'residues_only', count(*), count(*) FILTER (WHERE NOT regexp_matches(sequence, '^[A-Z]+$')) FROM r
UNION ALL
SELECT 'span_equals_length', count(*), count(*) FILTER (WHERE end_position - start_position + 1 <> peptide_length) FROM r
UNION ALL
SELECT 'modified_has_modification', count(*), count(*) FILTER (WHERE is_modified AND len(modifications) = 0) FROM r"""
    ),
    "slug_values": f"""SELECT p_partkey, p_brand || ' - ' || p_type || ' (%)' AS name,
       {_slug_sql("p_brand || ' - ' || p_type || ' (%)'")} AS slug FROM part""",
    "cast_audit": _audit_sql(),
}


# Import path: shards written from the driver tables, read back.
from tessera.plans import export_import as _export_import  # noqa: E402

QUERIES.update(_export_import.QUERIES)
ORACLES.update(_export_import.ORACLES)
ORACLES["fuzzy_join_indexed"] = ORACLES["fuzzy_join"]
ORACLES["import_then_reduce"] = ORACLES["reduced_table"]
