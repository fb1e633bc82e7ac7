"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: The white space every contract of this subpackage means: [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\x0c\r"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without_white_space(text: Column) -> Column:
    """``text`` without the six white-space characters (plain replacements, no regular expression)."""
    for c in WHITE_SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder of the cluster and read back.

    Cuts the lineage: what follows survives lost executors without recomputing
    ``df``. The folder is a fresh one under ``spark.checkpoint.dir``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with this package importable where the tasks run.

    Workers on this machine get the package's folder on their path; on a cluster the package is
    installed or shipped with ``--py-files``.
    """
    paths = df.sparkSession.sparkContext.environment
    known = [p for p in paths.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in known:
        paths["PYTHONPATH"] = os.pathsep.join([_ROOT, *known])
    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply a batch function on each Arrow batch; ``make`` sets it up once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return arrow_map(df, run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def rank_within(df: DataFrame, key: str, parts: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """``df`` with a gapless rank from 0 within ``key``, no task ranking a whole hot key.

    ``parts`` (key, n_parts) says into how many salted parts each key is split; it has to be small
    enough to broadcast. Each part is ranked by itself and starts where the parts before it end.
    """
    salted = df.join(F.broadcast(parts), key).withColumn(
        "__part", F.pmod(F.xxhash64(*order), F.col("n_parts"))).drop("n_parts")
    counts = salted.groupBy(key, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(key, "__part", (
        F.sum("__n").over(W.partitionBy(key).orderBy("__part")) - F.col("__n")).alias("__before"))
    within = F.row_number().over(W.partitionBy(key, "__part").orderBy(*order)) - 1
    return salted.withColumn("__within", within).join(before, [key, "__part"]).withColumn(
        name, F.col("__before") + F.col("__within")).drop("__part", "__within", "__before")


def in_text_groups(batches: Iterator[pa.RecordBatch], most: int = 6_000_000) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of consecutive rows, together about ``most`` code points or one longer text."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            text = text.as_py() or ""
            if texts and size + len(text) > most:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id.as_py())
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts
