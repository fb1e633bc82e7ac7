"""Readers: sharded CSV exports with a multi-row header, Parquet, SQL over files."""
