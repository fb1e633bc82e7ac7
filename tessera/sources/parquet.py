"""Parquet scans and SQL over files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.edit_distance import register_sql_functions

# How documented statements name a Parquet file; Spark's own SQL writes parquet.`path`.
_READ_PARQUET = re.compile(r"\bread_parquet\(\s*'([^']*)'\s*\)")


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Lazy columnar scan; filters and column selections reach the reader."""
    return spark.read.parquet(path)


def sql_over_files(spark: SparkSession, query: str, **tables: str | DataFrame) -> DataFrame:
    """Run ``query`` with each keyword bound to the ``{name}`` in it, without a view that stays.

    A value is either a Parquet path or a DataFrame. A query may also name a file
    directly, as ``parquet.`/path/to/table``` or ``read_parquet('/path/to/table')``, and call
    ``damerau_levenshtein(a, b)``.
    """
    register_sql_functions(spark)
    query = _READ_PARQUET.sub(lambda m: f"parquet.`{m[1]}`", query).rstrip().removesuffix(";")
    frames = {name: src if isinstance(src, DataFrame) else spark.read.parquet(src) for name, src in tables.items()}
    return spark.sql(query, **frames)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows in a Parquet table (answered from footers where the reader allows)."""
    return spark.read.parquet(path).count()
