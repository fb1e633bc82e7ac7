"""Ranking, top-k and key lookup operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(spec: Sequence[Column | str]) -> list[Column]:
    return [F.col(s) if isinstance(s, str) else s for s in spec]


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key under ``order`` (which must end in a full tie-break).

    ``row_number() ... = 1`` plans as a partial ``WindowGroupLimit`` before the
    shuffle, so every map task forwards at most one row per key: a key holding a
    third of the data still ships one row per task, not its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def best_row(df: DataFrame, key_col: str, key_value, order: Sequence[Column | str]) -> DataFrame:
    """The best row for one key value (an empty frame when the key is absent)."""
    return df.where(F.col(key_col) == F.lit(key_value)).orderBy(*_order(order)).limit(1)


def top_groups(
    df: DataFrame,
    group_cols: Sequence[str],
    aggs: Sequence[Column],
    order: Sequence[Column | str],
    n: int,
) -> DataFrame:
    """Aggregate per group and keep the first ``n`` groups (plans as TakeOrderedAndProject)."""
    return df.groupBy(*group_cols).agg(*aggs).orderBy(*_order(order)).limit(n)


def lookup(df: DataFrame, col: str, keys: DataFrame | Iterable, in_list: bool = True) -> DataFrame:
    """Rows whose ``col`` is one of ``keys``.

    A Python collection becomes an IN-list that reaches the Parquet scan, or with
    ``in_list=False`` a table; a keys DataFrame (any size) becomes a left semi join,
    leaving the optimizer to broadcast it only when its measured size allows.
    """
    if not isinstance(keys, DataFrame):
        values = list(dict.fromkeys(keys))
        if in_list:
            return df.where(F.col(col).isin(values))
        keys = df.sparkSession.createDataFrame([(v,) for v in values], [col])
    k = keys.select(F.col(keys.columns[0]).alias("_lookup_key")).where(F.col("_lookup_key").isNotNull())
    return df.join(k, df[col] == k["_lookup_key"], "left_semi")



def exact_lookup(df: DataFrame, col: str, value) -> DataFrame:
    """Equality lookup; on a table sorted by ``col`` the Parquet reader skips row groups."""
    return df.where(F.col(col) == F.lit(value))
