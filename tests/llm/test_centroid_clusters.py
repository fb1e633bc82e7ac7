"""Centroid clustering against a plain version and against SQL."""

import hashlib
import math
import random

import numpy as np
import pytest

from tessera.llm import centroid_clusters
from tessera.llm.centroid_clusters import _coded, cluster_vectors, nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster string, id string, distance double"


def plain(rows, dims=64, scale=64, k=16, rounds=3):
    """Every distance by definition, with Python integers."""
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        groups = {}
        for (_, v), (_, n) in zip(kept, assign()):
            groups.setdefault(n, []).append(v)
        for n, members in groups.items():
            centroids[n] = [sum(column) // len(members) for column in zip(*members)]
    found = assign()
    inertia = {}
    for d, n in found:
        inertia[n] = inertia.get(n, 0) + d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
                   for (i, _), (d, n) in zip(kept, found)), key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "c", "x", 0.5) for i, v in rows], SCHEMA).repartition(parts)


def some_vectors(n, seed=1, dims=64, spread=0.4):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.3) for _ in range(dims)] for _ in range(20)]
    return [(i, [c + rnd.gauss(0, spread) * 0.2 for c in rnd.choice(centres)]) for i in range(n)]


def found(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_the_plain_version(spark):
    rows = some_vectors(700)
    assert found(cluster_vectors(table(spark, rows))) == plain(rows)


def test_blocks_of_any_size_agree(spark, monkeypatch):
    rows = some_vectors(300, seed=4)
    monkeypatch.setattr(centroid_clusters, "BLOCK", 7)
    batch = next(iter(table(spark, rows, 1).selectExpr("vec_id id", "transform(embedding, x -> bigint(floor(x * 64))) v").toArrow().to_batches()))
    assert [len(b.column("ids")[0]) for b in _coded([batch])] == [7] * 42 + [6]


def test_odd_rows(spark):
    rnd = random.Random(9)
    good = some_vectors(60, seed=2)
    v = good[0][1]
    rows = good + [
        (100, None), (101, []), (102, v[:63]), (103, v + [0.0]), (104, [None, *v[1:]]), (105, [float("nan"), *v[1:]]),
        (106, [float("inf"), *v[1:]]), (107, [float("-inf"), *v[1:]]), (108, [0.0] * 64), (109, [-0.0] * 64), (110, [1e-30] * 64),
        (111, [-1e-30] * 64), (112, v), (113, v), (113, v), (113, [x + 0.1 for x in v]), (None, v), (None, [-x for x in v]),
        (114, [1000.0 * rnd.random() for _ in range(64)]), (115, [2.0 ** 20] * 64), (116, [-(2.0 ** 20)] * 64)]
    assert found(cluster_vectors(table(spark, rows))) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 5, 16, 17])
def test_few_vectors(spark, n):
    rows = some_vectors(n, seed=n) + [(900, None)]
    assert found(cluster_vectors(table(spark, rows))) == plain(rows)


def test_one_vector_held_by_most_rows(spark):
    rows = some_vectors(200, seed=6)
    rows += [(1000 + n, rows[3][1]) for n in range(1200)]
    assert found(cluster_vectors(table(spark, rows, 5))) == plain(rows)


def test_ties_go_to_the_smaller_number():
    seen, codes = [np.array([0, 2])], np.array([[0, 1]], "<u2")
    cluster, distance = nearest(seen, codes, np.array([[1], [1], [-1]]))
    assert cluster.tolist() == [0, 0] and distance.tolist() == [1, 1]


def test_components_too_large_for_the_distance_raise(spark):
    with pytest.raises(Exception, match="passes"):
        cluster_vectors(table(spark, [(1, [1e30] * 64)]))
