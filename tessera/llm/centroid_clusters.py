"""Centroid clustering of integer vectors over scalar lookup tables.

Vectors are kept as blocks, coded dimension by dimension: a sorted list of the values that occur in the block, and
each vector's place in it. In every round a block tabulates the squared difference of each of these
values from each centroid; a vector's distances are then gathers from the tables, summed over the dimensions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, written
from tessera.llm.vectors import finite, whole_components

#: Vectors of a block: bounds a task's memory (codes fit 16 bits, distances are block x centroids).
BLOCK = 4096
_BLOCKS = "ids array<bigint>, seen array<array<bigint>>, codes binary"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            ids, vectors = part.column("id"), part.column("v")
            rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            seen, codes = zip(*(np.unique(column, return_inverse=True) for column in rows.T), strict=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                pa.array([[s.tolist() for s in seen]], pa.list_(pa.list_(pa.int64()))),
                pa.array([np.concatenate(codes).astype("<u2").tobytes()], pa.binary()),
            ], names=["ids", "seen", "codes"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray], np.ndarray]]:
    """(ids, occurring values per dimension, codes per dimension and vector) of each block."""
    for batch in batches:
        for ids, seen, codes in zip(batch.column("ids"), batch.column("seen"), batch.column("codes"), strict=True):
            values = [np.asarray(s, dtype=np.int64) for s in seen.as_py()]
            yield ids.values, values, np.frombuffer(codes.as_py(), "<u2").reshape(len(values), -1)


def nearest(seen: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; the smaller number on ties."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    gathered = np.empty_like(total)
    for d, values in enumerate(seen):
        table = (values[:, None] - centroids[None, :, d]) ** 2
        total += np.take(table, codes[d], axis=0, out=gathered)
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(cluster)), cluster]


def _cluster_sums(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, dict[int, int]]]:
    """Per non-empty cluster: its size and its exact sum in each dimension (clusters x dimensions rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        sums, sizes = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, seen, codes in _blocks(batches):
            cluster, _ = nearest(seen, codes, centroids)
            sizes += np.bincount(cluster, minlength=k)
            for d, values in enumerate(seen):
                times = np.bincount(cluster * len(values) + codes[d], minlength=k * len(values))
                sums[:, d] += times.reshape(k, -1) @ values
        some = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(some, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(some)), pa.int32()),
            pa.array(sums[some].ravel(), pa.int64()), pa.array(np.repeat(sizes[some], dims), pa.int64()),
        ], names=["cluster", "dim", "total", "size"])

    parts = arrow_map(blocks, run, "cluster int, dim int, total bigint, size bigint")
    found: dict[int, tuple[int, dict[int, int]]] = {}
    for r in parts.groupBy("cluster", "dim").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("size").alias("size")).collect():
        found.setdefault(r.cluster, (r["size"], {}))[1][r.dim] = int(r.total)
    return found


def _assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, seen, codes in _blocks(batches):
            cluster, distance = nearest(seen, codes, centroids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    return arrow_map(blocks, run, "id bigint, cluster int, distance bigint")


def cluster_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    dims: int = 64, scale: int = 64, n_clusters: int = 16, rounds: int = 3, seed: str = "1:",
) -> DataFrame:
    """Per vector: its id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256.

    Vectors take part that have exactly ``dims`` components, none null or not finite; each component becomes
    floor(scale * x). Centroids start as the ``n_clusters`` vectors whose sha256 of ``seed`` + id is smallest (all
    vectors, if there are fewer), in that order. A round assigns every vector and moves each
    centroid to floor(sum / count) of its vectors; empty ones stay. Vectors are then assigned once more.

    Repeated rows are vectors of their own, and repeated ids start in the order of their components; a null id hashes as
    the empty string. No vectors give no rows. Components over 2^27 after scaling raise, since squared
    distances would pass 64 bits. Other columns are not looked at.

    The driver holds the centroids and, each round, one sum per cluster and dimension, whatever the input.
    """
    v = F.col(vector_column)
    kept = vectors.where((F.size(v) == dims) & finite(v)).select(
        F.col(id_column).cast("long").alias("id"), whole_components(v, scale).alias("v"))
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.withColumn("key", key).orderBy("key", "v").limit(n_clusters).collect()
    if not first:
        return kept.sparkSession.createDataFrame([], (
            f"{id_column} bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"))
    centroids = np.array([r.v for r in first], np.int64)
    blocks = written(arrow_map(kept, _coded, _BLOCKS), "vector-blocks")
    for _ in range(rounds):
        for cluster, (size, total) in _cluster_sums(blocks, centroids).items():
            centroids[cluster] = [total[d] // size for d in range(dims)]
    assigned = written(_assigned(blocks, centroids), "vector-clusters")
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    clusters = kept.sparkSession.createDataFrame(
        [(c, inertia[c], sum(inertia.values()), digests[c]) for c in sorted(inertia)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
