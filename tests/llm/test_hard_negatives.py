"""Hard negatives against every pair by definition, and the parts of the method."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives as hn
from tessera.llm.hard_negatives import bounds, first_of_each, hilbert_key, mine_hard_negatives, products

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, block double, score string, number int"


def plain(rows, is_anchor=lambda i: i % 10 == 0):
    """Every pair scored with Python integers."""
    kept = {(i, label, tuple(math.floor(float(np.float32(x)) * 256) for x in v)) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, label, v in kept:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, u)), j, other) for j, other, u in kept)
        for s, j, _ in [r for r in scored if r[2] == label and r[1] != i][:5]:
            window = [r for r in scored if r[2] != label and -80 * s <= -100 * r[0] <= -100 * s][:5]
            out += [(i, j, n, k, -s, -t) for n, (t, k, _) in enumerate(window, 1)]
    return sorted(out)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, label, "x", 1.5, "y", 7) for i, v, label in rows], SCHEMA).repartition(parts)


def found(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def mine(spark, rows, parts=3):
    return found(mine_hard_negatives(table(spark, rows, parts), F.col("vec_id") % 10 == 0))


def vectors(n, seed=1, dims=16, labels=4, centres=6, spread=0.05):
    rnd = random.Random(seed)
    middle = [[rnd.gauss(0, 0.3) for _ in range(dims)] for _ in range(centres)]
    return [(i, [c + rnd.gauss(0, spread) for c in rnd.choice(middle)], rnd.randrange(labels)) for i in range(n)]


def test_equals_the_plain_version(spark):
    rows = vectors(400)
    want = plain(rows)
    assert len(want) > 300 and mine(spark, rows) == want


def test_small_blocks_and_tiles_agree(spark, monkeypatch):
    for name, value in (("BLOCK", 8), ("ANCHORS", 5), ("READ", 3), ("ZONES", 4), ("SLICE", 2)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(300, seed=3)
    assert mine(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = vectors(80, seed=5)
    v = rows[0][1]
    rows += [
        (100, None, 1), (110, v, None), (None, v, 1), (120, [None, *v[1:]], 1), (130, [float("nan"), *v[1:]], 1),
        (140, [float("inf"), *v[1:]], 2), (150, [], 0), (160, v[:5], 0), (170, v + [0.5], 1), (171, v, 1), (172, v, 2), (173, v, 2),
        (180, v, 1), (180, v, 1), (180, [x + 0.01 for x in v], 1), (180, v, 2), (190, [0.0] * 16, 3), (200, [-x for x in v], 9), (201, v, 9),
        (-10, v, 0), (210, [90.0] * 16, 7), (211, [80.0] * 16, 7), (212, [75.0] * 16, 8)]
    assert mine(spark, rows) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(10, [0.5], 1)], [(10, [0.5], 1), (11, [0.5], 1)], [(11, [0.5], 1), (12, [0.5], 2)],
                                  [(10, [0.5], 1), (11, [0.5], 1), (12, [0.5], 2)], [(10, None, 1)], [(10, [], 1), (11, [], 1), (12, [], 2)]])
def test_few_rows(spark, rows):
    assert mine(spark, rows) == plain(rows)


def test_one_vector_held_by_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 64)
    rows = vectors(400, seed=8)
    rows += [(1000 + n, rows[1][1], n % 2) for n in range(200)]
    assert mine(spark, rows, 7) == plain(rows)


def test_scores_past_the_exact_doubles(spark):
    rnd = random.Random(4)
    rows = [(n, [rnd.uniform(1e4, 5e5) for _ in range(6)], n % 3) for n in range(60)]
    assert mine(spark, rows) == plain(rows)


def test_hilbert_key_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        side = np.arange(1 << bits)
        cells = np.stack(np.meshgrid(*[side] * dims), axis=-1).reshape(-1, dims)
        key = hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_bounds_hold_for_every_row_of_a_zone():
    rng = np.random.default_rng(3)
    zone, anchors = rng.integers(-50, 50, (40, 9)), rng.integers(-50, 50, (12, 9))
    least, most = bounds(anchors, zone.min(axis=0)[None, :], zone.max(axis=0)[None, :])
    scores = products(anchors, zone)
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()


def test_blocks_that_cannot_meet_a_window_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 32)
    rows = vectors(1500, seed=6, dims=8, labels=2, centres=30, spread=0.01)
    read = []
    chosen = hn._chosen

    def counted(anchors, blocks, n_tiles, n_blocks, same, n_windows):
        out = chosen(anchors, blocks, n_tiles, n_blocks, same, n_windows)
        read.append((out.count(), n_tiles * n_blocks))
        return out

    monkeypatch.setattr(hn, "_chosen", counted)
    monkeypatch.setattr(hn, "ANCHORS", 4)
    got = mine(spark, rows)
    assert got == plain(rows)
    # half of the blocks have the right label; of those, most cannot meet a window
    assert read[0][0] < 0.25 * read[0][1] and read[1][0] < 0.25 * read[1][1], read


def test_first_of_each():
    who, score, ids = np.array([0, 1, 0, 0, 1]), np.array([5, 1, 7, 5, 2]), np.array([9, 1, 3, 2, 8])
    assert sorted(first_of_each(who, score, ids, 2).tolist()) == [1, 2, 3, 4]


def test_scores_too_large_raise():
    with pytest.raises(OverflowError):
        products(np.full((1, 64), 1 << 27), np.full((1, 64), 1 << 27))
