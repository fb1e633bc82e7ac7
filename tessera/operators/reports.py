"""Report queries and one-row summaries (all single aggregates, no driver loops)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import distinct_count_with_nulls, row_count
from tessera.operators.ranking import top_groups


def class_report(
    export: DataFrame,
    restriction_class: str = "I",
    min_year: int = 2020,
    n: int = 5,
    name_col: str = "mhc_restriction_name",
    class_col: str = "mhc_restriction_class",
    year_col: str = "reference_date",
    start_col: str = "epitope_starting_position",
    end_col: str = "epitope_ending_position",
) -> DataFrame:
    """Assays and mean epitope span per restriction for one class from ``min_year`` on; top ``n``.

    Ties on the assay count break by restriction name, ascending, nulls last.
    The per-restriction aggregate is partial (map-side), so a restriction that
    holds most rows costs one buffer per task.
    """
    rows = export.where((F.col(class_col) == F.lit(restriction_class)) & (F.col(year_col) >= F.lit(min_year)))
    span = F.col(end_col) - F.col(start_col) + F.lit(1)
    return top_groups(
        rows,
        [name_col],
        [row_count().alias("assays"), F.round(F.avg(span), 1).alias("mean_len")],
        [F.col("assays").desc(), F.col(name_col).asc_nulls_last()],
        n,
    )


def reduced_summary(reduced: DataFrame) -> DataFrame:
    """Rows, distinct sequences, percent with an accession, modified rows (one row).

    An empty table gives a null percentage rather than a division error.
    """
    n = row_count()
    return reduced.agg(
        n.alias("rows"),
        distinct_count_with_nulls("sequence").alias("distinct_sequences"),
        F.count("uniprot_id").alias("with_uniprot"),
        F.round(F.try_divide(F.lit(100.0) * F.count("uniprot_id"), n), 1).alias("pct_with_uniprot"),
        F.count_if(F.col("is_modified")).alias("modified"),
        F.count_if(F.col("allele_is_specific")).alias("specific_allele_rows"),
    )


def import_summary(table: DataFrame, input_bytes: int | None = None, output_bytes: int | None = None,
                   elapsed_s: float | None = None) -> DataFrame:
    """Rows and columns of an imported table, with the sizes and time measured around the write."""
    ratio = None if not (input_bytes and output_bytes) else round(input_bytes / output_bytes, 1)
    return table.agg(row_count().alias("rows")).select(
        "rows",
        F.lit(len(table.columns)).alias("columns"),
        F.lit(input_bytes).cast("bigint").alias("input_bytes"),
        F.lit(output_bytes).cast("bigint").alias("output_bytes"),
        F.lit(ratio).cast("double").alias("compression"),
        F.lit(elapsed_s).cast("double").alias("elapsed_s"),
    )
