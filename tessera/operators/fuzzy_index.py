"""A written index for fuzzy matching: targets are expanded once, then only new ones.

Two Parquet tables under one path, both bucketed: ``keys`` (a target under each of its keys, by key) and ``strings``
(the targets in the index, by string). A batch of queries is expanded and joined to ``keys`` bucket by
bucket: the targets are neither read, expanded nor shuffled again.

The tables are external ones in the session's catalog, which gives Spark their buckets; :meth:`FuzzyIndex.close`
takes their names out again and leaves the files.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.similarity import distinct_strings, pairs_by_key, query_keys, target_keys

_COLUMNS = {"keys": ("_t string, _key bigint, _t_at int, _t_len int", "_key"), "strings": ("_t string", "_t")}


@dataclass
class FuzzyIndex:
    spark: SparkSession
    path: str
    k: int
    n_buckets: int

    def _table(self, part: str) -> str:
        """Name of one of the tables in the catalog, made known to it first."""
        name = f"fuzzy_index_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{part}"
        columns, by = _COLUMNS[part]
        place = f"{self.path}/{part}".replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                       f"INTO {self.n_buckets} BUCKETS LOCATION '{place}'")
        return name

    def _append(self, rows: DataFrame, part: str) -> None:
        name, by = self._table(part), _COLUMNS[part][1]
        # a task for each bucket, so a batch adds one file to it
        rows.repartition(self.n_buckets, by).sortWithinPartitions(by).write.insertInto(name)

    def add(self, targets: DataFrame, col: str) -> None:
        """Expand and append the strings of ``col`` that the index does not hold yet; nulls are left out.

        Keys come first: if the job is lost in between, adding the same strings again writes keys twice, which
        results do not show.
        """
        known = self.spark.table(self._table("strings"))
        new = distinct_strings(targets, col, "_t").join(known, "_t", "left_anti")
        self._append(target_keys(new, self.k, known=self.spark.table(self._table("keys"))), "keys")
        # a plan of its own: what was new is read off the index, not off the targets' expansion
        self._append(distinct_strings(targets, col, "_t").join(known, "_t", "left_anti"), "strings")

    def pairs(self, queries: DataFrame, col: str) -> DataFrame:
        """Distinct ``query_sequence, sequence, distance`` with a distance of at most ``k`` to a target."""
        qk = query_keys(distinct_strings(queries, col, "_q"), self.k)
        return pairs_by_key(qk, self.spark.table(self._table("keys")), self.k)

    def join(self, queries: DataFrame, q_col: str, rows: DataFrame, col: str) -> DataFrame:
        """The rows whose ``col`` is within ``k`` of a query, with ``query_sequence`` and ``distance``."""
        pairs = self.pairs(queries, q_col).withColumnRenamed("sequence", "_match")
        return rows.join(pairs, F.col(col) == F.col("_match")).drop("_match")

    def close(self) -> None:
        for part in _COLUMNS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(part)}")


def write_fuzzy_index(targets: DataFrame, col: str, k: int, path: str, n_buckets: int = 64) -> FuzzyIndex:
    """A new index of the strings in ``col`` for distances up to ``k``.

    ``n_buckets`` is fixed for the life of the index: choose it so that a bucket of keys fits a task.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    spark = targets.sparkSession
    spark.createDataFrame([(k, n_buckets)], "k int, n_buckets int").write.parquet(f"{path}/settings")
    index = FuzzyIndex(spark, path, k, n_buckets)
    index.add(targets, col)
    return index


def open_fuzzy_index(spark: SparkSession, path: str) -> FuzzyIndex:
    """The index that :func:`write_fuzzy_index` left under ``path``."""
    settings = spark.read.parquet(f"{path}/settings").first()
    return FuzzyIndex(spark, path, settings["k"], settings["n_buckets"])
