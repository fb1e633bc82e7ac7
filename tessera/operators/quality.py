"""Data-quality checks over a reduced table.

Each ``check_*`` returns the *violating* rows (or keys) as a DataFrame, so a
caller can count them, show a sample or write them out; ``quality_report``
counts every check in one pass over the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import RESIDUES_ONLY_PATTERN
from tessera.operators.reduce import GRAIN


def check_unique(df: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Key combinations (null-aware) that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_pattern(df: DataFrame, col: str = "sequence", pattern: str = RESIDUES_ONLY_PATTERN) -> DataFrame:
    """Rows whose ``col`` does not match ``pattern`` (null values are not judged)."""
    return df.where(~F.col(col).rlike(pattern))


def check_span(df: DataFrame, start: str = "start_position", end: str = "end_position",
               length: str = "peptide_length") -> DataFrame:
    """Rows whose position span differs from the sequence length."""
    return df.where((F.col(end) - F.col(start) + 1) != F.col(length))


def check_flag_list_consistent(df: DataFrame, flag: str = "is_modified", values: str = "modifications") -> DataFrame:
    """Rows flagged as modified that carry no modification."""
    return df.where(F.col(flag) & (F.size(values) == 0))


def check_expected(df: DataFrame, expected: DataFrame, key: str, order: Sequence, compare: Sequence[str],
                   where=None) -> DataFrame:
    """Keys whose best row disagrees with ``expected`` (null-safe), or that are missing.

    ``expected`` holds ``key`` plus the ``compare`` columns; ``order`` picks the
    best row per key (see ``best_per_key``).
    """
    from tessera.operators.ranking import best_per_key

    rows = df if where is None else df.where(where)
    best = best_per_key(rows.join(expected.select(key), key, "left_semi"), [key], order)
    exp = expected.select(key, *[F.col(c).alias(f"expected_{c}") for c in compare])
    got = best.select(key, *compare, F.lit(True).alias("_present"))
    joined = exp.join(got, key, "left")
    ok = F.coalesce(F.col("_present"), F.lit(False))
    for c in compare:
        ok = ok & F.col(c).eqNullSafe(F.col(f"expected_{c}"))
    return joined.where(~ok).withColumn("found", F.coalesce(F.col("_present"), F.lit(False))).drop("_present")


def quality_report(df: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """One row per check: ``check``, ``n_rows``, ``n_violations``.

    One grouping by ``keys`` carries each key's rows and violations, and one global
    aggregate of those sums gives every check, uniqueness included.
    """
    row_checks = {
        "residues_only": ~F.col("sequence").rlike(RESIDUES_ONLY_PATTERN),
        "span_equals_length": (F.col("end_position") - F.col("start_position") + 1) != F.col("peptide_length"),
        "modified_has_modification": F.col("is_modified") & (F.size("modifications") == 0),
    }
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(n) for n, c in row_checks.items()])
    totals = per_key.agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("grain_unique"), *[F.sum(n).alias(n) for n in row_checks])
    checks = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("v")) for n in ("grain_unique", *row_checks)])
    zero = F.lit(0).cast("bigint")
    return totals.select("n_rows", F.explode(checks).alias("c")).select(
        "c.check", F.coalesce("n_rows", zero).alias("n_rows"), F.coalesce("c.v", zero).alias("n_violations"))
