"""Incremental import of arriving shards with Structured Streaming.

New ``<stem>_NN.csv`` files dropped into the export directory are picked up by
the file source, cleaned exactly as the batch import does (header rows out,
rows with extra fields raise, strict casts on the composed names, slugs) and
appended to a Parquet table. The checkpoint, kept inside the output folder unless
given, records which files were committed, so a restarted or re-run query imports
every shard exactly once, and ``availableNow`` processes what is there in bounded
micro-batches, then stops.

The header shard is a source of its own, whose leading records are dropped by their
place; the other shards are one source that prunes columns and stays JVM-side.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.sinks.writers import DEFAULT_CODEC, DEFAULT_LEVEL
from tessera.sources.sharded_csv import (
    NAME_SEP,
    check_width,
    compose_name,
    default_casts,
    list_shards,
    name_columns,
    raw_records,
    read_header_rows,
    slug_columns,
    strict_cast,
)

#: Inside the output folder; readers skip names that start with an underscore.
CHECKPOINT = "_import_checkpoint"


def _without_leading(records: DataFrame, n: int) -> DataFrame:
    """``records`` of one file without the first ``n`` (a task reads a file's first split from its start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = n
        for batch in batches:
            leading = np.flatnonzero(batch.column(batch.num_columns - 1).to_numpy() == 0)[:left]
            left -= len(leading)
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[leading] = False
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(keep))

    return records.select("*", "_metadata.file_block_start").mapInArrow(run, records.schema)


def stream_shards(
    spark: SparkSession,
    path: str,
    casts: dict[str, str] | None = None,
    slugs: bool = True,
    multiline: bool = True,
    max_files_per_trigger: int | None = None,
    sep: str = NAME_SEP,
    exact_text: bool = True,
) -> DataFrame:
    """A streaming DataFrame over the shards of ``path`` (the header shard must already exist)."""
    shards = list_shards(spark, path)
    header_rows = read_header_rows(spark, shards[0])
    names = [compose_name(g, f, sep) for g, f in zip(*header_rows, strict=True)]
    if casts is None:
        casts = default_casts(names)
    header_name = shards[0].rsplit("/", 1)[-1]

    def source(names_like: str) -> DataFrame:
        reader = spark.readStream.option("pathGlobFilter", names_like)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return raw_records(reader, path, len(names), multiline)

    first = check_width(_without_leading(source(header_name), len(header_rows)))
    others = check_width(source("*.csv").where(F.col("_metadata.file_name") != F.lit(header_name)))
    out = name_columns(others.union(first), names)
    if casts:
        out = strict_cast(out, casts, exact_text)
    return slug_columns(out) if slugs else out


def import_arriving_shards(
    spark: SparkSession,
    path: str,
    out: str,
    casts: dict[str, str] | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    multiline: bool = True,
    codec: str = DEFAULT_CODEC,
    level: int | None = DEFAULT_LEVEL,
) -> StreamingQuery:
    """Append every not-yet-imported shard to the Parquet table at ``out``; returns the query.

    Without ``checkpoint`` the progress is kept in the output folder, so a later run goes on from it.
    Runs with ``availableNow``: call ``awaitTermination()`` on the result.
    """
    stream = stream_shards(spark, path, casts, multiline=multiline, max_files_per_trigger=max_files_per_trigger)
    ck = checkpoint or f"{out.rstrip('/')}/{CHECKPOINT}"
    writer = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", ck)
        .option("compression", codec)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if codec == "zstd" and level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    return writer.start(out)


# Ship this module's code with the tasks by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
