"""Writers: typed Parquet (zstd), CSV reports, column catalogs."""

from tessera.sinks.writers import (
    flatten_lists,
    write_catalog_json,
    write_csv_report,
    write_parquet,
    write_reduced_table,
)

from tessera.sinks.convert import convert_to_parquet  # noqa: E402

__all__ = ["convert_to_parquet", "flatten_lists", "write_catalog_json", "write_csv_report", "write_parquet", "write_reduced_table"]
