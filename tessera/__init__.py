"""tessera: turn sharded, awkwardly headed exports into typed, query-ready Spark tables,
reduce them to a chosen grain, and search them by exact and edit-distance matching.

Every function takes and returns Spark DataFrames or Columns.
"""

__version__ = "0.1.0"

_EXPORTS = {
    "tessera.session": ["get_session", "shared_dir", "scratch_path", "release_scratch"],
    "tessera.functions.naming": ["slugify", "slug_expr"],
    "tessera.functions.text": ["clean_sequence", "extract_or_null", "accession", "epitope_id", "flag_matches"],
    "tessera.functions.edit_distance": ["damerau_levenshtein", "dl_distance", "within_prefilter"],
    "tessera.sources.sharded_csv": ["list_shards", "read_header", "read_header_rows", "read_sharded_csv",
                                    "strict_cast", "slug_columns", "describe_source", "write_sharded_csv",
                                    "scan_shard"],
    "tessera.sources.parquet": ["scan_parquet", "sql_over_files"],
    "tessera.operators.aggregates": ["first_non_null", "modal_value", "modal_tuple", "distinct_sorted_list",
                                     "distinct_count_with_nulls", "row_count"],
    "tessera.operators.reduce": ["extract_fields", "reduce_to_grain", "modal_pair_per_grain", "sort_by_grain",
                                 "GRAIN"],
    "tessera.operators.ranking": ["best_per_key", "best_row", "top_groups", "lookup", "exact_lookup"],
    "tessera.operators.similarity": ["fuzzy_sweep", "fuzzy_pairs", "fuzzy_join", "deletion_variants"],
    "tessera.operators.reports": ["class_report", "reduced_summary", "import_summary"],
    "tessera.operators.quality": ["check_unique", "check_pattern", "check_span", "check_flag_list_consistent",
                                  "check_expected", "quality_report"],
    "tessera.operators.catalog": ["describe_table", "audit_casts"],
    "tessera.sinks.writers": ["write_parquet", "write_reduced_table", "write_csv_report", "write_catalog_json",
                              "flatten_lists"],
    "tessera.sinks.convert": ["convert_to_parquet"],
    "tessera.streaming.shard_stream": ["stream_shards", "import_arriving_shards"],
}
_WHERE = {name: module for module, names in _EXPORTS.items() for name in names}
__all__ = sorted(_WHERE)


def __getattr__(name):
    # lazy, so importing the package does not import pyspark submodules eagerly
    if name in _WHERE:
        import importlib

        return getattr(importlib.import_module(_WHERE[name]), name)
    raise AttributeError(name)
