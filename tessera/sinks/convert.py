"""Sharded CSV export -> typed, slugged Parquet, with an import summary."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.reports import import_summary
from tessera.session import hadoop_fs
from tessera.sinks.writers import DEFAULT_CODEC, DEFAULT_LEVEL, write_parquet
from tessera.sources.sharded_csv import input_bytes, read_sharded_csv


def convert_to_parquet(spark: SparkSession, src: str, out: str, casts: dict[str, str] | None = None,
                       codec: str = DEFAULT_CODEC, level: int = DEFAULT_LEVEL, multiline: bool = True,
                       exact_text: bool = True) -> DataFrame:
    """Import every shard of ``src`` into Parquet at ``out``; returns a one-row summary
    (rows, columns, input and output bytes, compression ratio, elapsed seconds)."""
    t0 = time.perf_counter()
    table = read_sharded_csv(spark, src, casts=casts, multiline=multiline, exact_text=exact_text)
    write_parquet(table, out, codec, level)
    elapsed = time.perf_counter() - t0
    fs, jpath = hadoop_fs(spark, out)
    out_bytes = int(fs.getContentSummary(jpath).getLength())
    return import_summary(spark.read.parquet(out), input_bytes(spark, src), out_bytes, round(elapsed, 3))
