"""Distributed writers. Nothing here collects rows to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tessera.operators.reduce import GRAIN, sort_by_grain
from tessera.session import delete_created, scratch_path

# A codec that every Spark has, at a level where writing is still bound by parsing.
DEFAULT_CODEC = "zstd"
DEFAULT_LEVEL = 9
LIST_SEPARATOR = ","


def flatten_lists(df: DataFrame, sep: str = LIST_SEPARATOR) -> DataFrame:
    """Every array column as one string, its values joined by ``sep`` and not escaped."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType):
            cols.append(F.array_join(F.col(f.name).cast("array<string>"), sep).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_parquet(df: DataFrame, path: str, codec: str = DEFAULT_CODEC, level: int | None = DEFAULT_LEVEL,
                  mode: str = "overwrite", options: dict[str, str] | None = None) -> None:
    """Parquet with an explicit codec level. Output is a directory of part files."""
    w = df.write.mode(mode).option("compression", codec).options(**(options or {}))
    if codec == "zstd" and level is not None:
        w = w.option("parquet.compression.codec.zstd.level", str(level))
    w.parquet(path)


#: Bits of a Bloom filter for each distinct value, as chance of a false hit.
BLOOM_FALSE_HITS = 0.01


def bloom_options(columns: dict[str, int]) -> dict[str, str]:
    """Parquet options that give each row group a Bloom filter on ``columns`` (name -> distinct values expected in it)."""
    options = {}
    for name, n_values in columns.items():
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(n_values)
        options[f"parquet.bloom.filter.fpp#{name}"] = str(BLOOM_FALSE_HITS)
    return options


def write_reduced_table(reduced: DataFrame, path: str, grain=GRAIN, codec: str = DEFAULT_CODEC,
                        level: int | None = DEFAULT_LEVEL, bloom: dict[str, int] | None = None) -> DataFrame:
    """Write the reduced table sorted by its grain and return a lazy read of it.

    The global sort is a range-partitioned shuffle, so the output files hold
    disjoint, sorted key ranges and their row-group statistics let an equality
    lookup skip nearly everything. ``bloom`` (column -> distinct values expected
    in a row group) lets lookups by other columns skip row groups too.

    The aggregation is written once, unsorted, under the shared scratch folder. The
    sort samples its range bounds from that table and shuffles it: nothing is held
    in executors, and a lost one costs no second aggregation.
    """
    spark = reduced.sparkSession
    staged = scratch_path(spark, "reduced-unsorted")
    write_parquet(reduced, staged, codec="zstd", level=1)
    try:
        in_order = sort_by_grain(spark.read.schema(reduced.schema).parquet(staged), grain)
        write_parquet(in_order, path, codec, level, options=bloom_options(bloom or {}))
    finally:
        delete_created(spark, staged)
    return spark.read.parquet(path)


def write_csv_report(df: DataFrame, path: str, sep: str = LIST_SEPARATOR, single_file: bool = False,
                     order_by: list | None = None) -> None:
    """Header + one line per row; list columns joined first, rows optionally ordered.

    Values are written as they are, padding included. The tasks of the plan write a part file each
    (with ``order_by``, ordered part files); ``single_file`` is for results of a few rows, which it
    gathers after the work is done.
    """
    out = flatten_lists(df, sep)
    if single_file:
        # an exchange, and not coalesce: the work before it keeps its tasks
        out = out.repartition(1)
        if order_by:
            out = out.sortWithinPartitions(*order_by)
    elif order_by:
        out = out.orderBy(*order_by)
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_catalog_json(catalog: DataFrame, path: str, document: bool = False) -> None:
    """A column catalog (small by construction: one row per column) as JSON.

    ``document=True`` writes one object ``{"column_count": n, "columns": [...]}``
    with the columns in index order; otherwise one JSON line per column.
    """
    from tessera.operators.catalog import catalog_document

    out = catalog_document(catalog) if document else catalog
    out.coalesce(1).write.mode("overwrite").json(path)
