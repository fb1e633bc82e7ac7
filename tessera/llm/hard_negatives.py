"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates lie in Parquet blocks of one label each, ordered along a Hilbert curve through the
dimensions that vary most. A block's zone map (smallest and largest value of every dimension) bounds, by interval
arithmetic, the inner products that an anchor can have inside it. Blocks are read for an anchor only
where these bounds meet one of its windows of scores; whatever they cannot exclude is read and scored exactly.

Anchors and blocks meet in tiles of bounded size (``ANCHORS`` anchors by ``READ`` blocks), so neither side
is broadcast or gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, written
from tessera.llm.vectors import finite, whole_components

#: Candidates of a block; anchors of a tile; blocks and zone maps that a tile looks at.
BLOCK, ANCHORS, READ, ZONES = 1024, 2048, 8, 4096
#: The curve runs through so many dimensions, each cut into 2**BITS cells (key of at most 60 bits).
CURVE_DIMS, BITS = 12, 5
#: Anchors scored against a block at a time: bounds the matrix of scores.
SLICE = 512
_FAR = 1 << 60


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of the rows of ``cells`` (integers below 2**bits).

    The published transposed form (Skilling 2004): undo the excess rotations from the top bit down, take
    the Gray code, then interleave the bits of all dimensions.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        q, below = 1 << bit, (1 << bit) - 1
        for i in range(n):
            set_bit = (x[i] & q) != 0
            swap = np.where(set_bit, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(set_bit, below, swap)
            x[i] ^= swap if i else 0
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices; components that one lacks count as zero."""
    m = min(a.shape[1], b.shape[1])
    a, b = a[:, :m], b[:, :m]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    most = m * int(np.abs(a).max()) * int(np.abs(b).max())
    if most < 1 << 53:  # sums of doubles are exact up to here
        return a.astype(np.float64) @ b.astype(np.float64).T
    if most >= _FAR:
        raise OverflowError("scores pass 60 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible inner product of each anchor with a vector of each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _matrix(rows: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of integers as a matrix, shorter ones filled with zeros."""
    lists = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == lengths[0]).all():
        return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lengths), -1)
    out = np.zeros((len(lengths), lengths.max(initial=0)), np.int64)
    for place, values in enumerate(lists.to_pylist()):
        out[place, :len(values)] = values
    return out


def first_of_each(who: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` entries of each ``who``: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, who))
    sorted_who = who[order]
    start = np.searchsorted(sorted_who, sorted_who, side="left")
    return order[np.arange(len(order)) - start < k]


def _spread(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(dimension, least, largest value) of the dimensions that vary most, at most ``CURVE_DIMS`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"))
            if v.size:
                n, f = v.shape[1], v.astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n), pa.int32()), pa.array(np.full(n, len(v)), pa.int64()), pa.array(f.sum(axis=0)),
                     pa.array((f * f).sum(axis=0)), pa.array(v.min(axis=0)), pa.array(v.max(axis=0))],
                    names=["dim", "n", "total", "squares", "least", "most"])

    parts = arrow_map(rows.select("v"), run, "dim int, n bigint, total double, squares double, least bigint, most bigint")
    mean = F.sum("total") / F.sum("n")
    varies = F.sum("squares") / F.sum("n") - mean * mean
    found = parts.groupBy("dim").agg(varies.alias("varies"), F.min("least").alias("least"), F.max("most").alias("most"))
    return [(r.dim, r.least, r.most) for r in found.orderBy(F.desc("varies"), "dim").limit(CURVE_DIMS).collect()]


def _with_key(rows: DataFrame, spread: list[tuple[int, int, int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, key = _matrix(batch.column("v")), np.zeros(batch.num_rows, np.int64)
            if spread and v.size:
                cells = np.zeros((len(v), len(spread)), np.int64)
                for place, (dim, least, most) in enumerate(spread):
                    if dim < v.shape[1]:
                        cells[:, place] = np.clip((v[:, dim] - least) * (1 << BITS) // (most - least + 1), 0, (1 << BITS) - 1)
                key = hilbert_key(cells, BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "key"])

    return arrow_map(rows, run, "id bigint, label string, anchor boolean, v array<bigint>, key bigint")


_BLOCKS = ("block bigint, part int, label string, anchors_before bigint, ids array<bigint>, anchor array<boolean>, "
           "low array<bigint>, high array<bigint>, vectors binary")


def _sorted_parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """(label, parts of ids, anchors and vectors) of each block; a row equal to the one before it is left out."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    label_held, n_held, before = None, 0, None
    for batch in batches:
        ids = batch.column("id").to_numpy()
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
        lengths, v = pc.list_value_length(batch.column("v")).to_numpy(), _matrix(batch.column("v"))
        if not len(ids):
            continue
        again = np.zeros(len(ids), dtype=bool)
        again[1:] = (ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1]) & (lengths[1:] == lengths[:-1]) & (v[1:] == v[:-1]).all(axis=1)
        again[0] = before == (ids[0], labels[0], batch.column("v")[0].as_py())
        before = (ids[-1], labels[-1], batch.column("v")[-1].as_py())
        kept = np.flatnonzero(~again)
        ends = [*(np.flatnonzero(labels[kept][1:] != labels[kept][:-1]) + 1), len(kept)]
        start = 0
        for end in ends:
            while start < end:
                label = labels[kept[start]]
                if held and (label != label_held or n_held == size):
                    yield label_held, held
                    held, n_held = [], 0
                some = kept[start:min(end, start + size - n_held)]
                held.append((ids[some], anchor[some], v[some]))
                label_held, n_held, start = label, n_held + len(some), start + len(some)
    if held:
        yield label_held, held


def _to_blocks(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one label from sorted rows."""
    part = TaskContext.get().partitionId()
    n_anchors = 0
    ints = pa.list_(pa.int64())
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("label", pa.string()), ("anchors_before", pa.int64()),
                        ("ids", ints), ("anchor", pa.list_(pa.bool_())), ("low", ints), ("high", ints), ("vectors", pa.binary())])
    for number, (label, parts) in enumerate(_sorted_parts(batches, size)):
        width = max(v.shape[1] for _, _, v in parts)
        v = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for _, _, v in parts])
        anchor = np.concatenate([a for _, a, _ in parts])
        yield pa.RecordBatch.from_pylist([{
            "block": part << 32 | number, "part": part, "label": label, "anchors_before": n_anchors,
            "ids": np.concatenate([i for i, _, _ in parts]), "anchor": anchor, "low": v.min(axis=0), "high": v.max(axis=0),
            "vectors": v.astype("<i4").tobytes()}], schema)
        n_anchors += int(anchor.sum())


def _vectors(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(n, -1).astype(np.int64)


def write_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of rows (id, label, anchor, v), written; a block's number follows its label and place on the curve."""
    keyed = _with_key(rows, _spread(rows))
    order = ["label", "key", "id"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order, "v")
    return written(arrow_map(ordered, partial(_to_blocks, BLOCK), _BLOCKS), "zoned-blocks")


def _anchors(blocks: DataFrame, k: int) -> tuple[DataFrame, int]:
    """Anchors, numbered along the curve into tiles, each with one window for its ``k`` best rows of its label.

    The window starts at the k-th best score inside the anchor's own block, where its neighbours on the curve lie.
    """
    counts = blocks.groupBy("part").agg(F.sum(F.size(F.filter("anchor", lambda a: a))).alias("n"))
    starts, total = [], 0
    for r in counts.orderBy("part").collect():  # one row per partition of the ordered rows
        starts.append((r.part, total))
        total += r.n
    spark = blocks.sparkSession
    offsets = F.broadcast(spark.createDataFrame(starts, "part int, start bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.array(row["ids"], np.int64)
                v = _vectors(row["vectors"], len(ids))
                mine = np.flatnonzero(row["anchor"])
                scores = products(v[mine], v)
                for number, (place, score) in enumerate(zip(mine, scores)):
                    others = score[ids != ids[place]]
                    least = int(np.partition(others, len(others) - k)[len(others) - k]) if len(others) >= k else -_FAR
                    yield pa.RecordBatch.from_pylist([{
                        "number": row["start"] + row["anchors_before"] + number, "id": ids[place], "label": row["label"],
                        "v": v[place].tolist(), "windows": [{"low": least, "high": _FAR}]}], schema)

    window = pa.struct([("low", pa.int64()), ("high", pa.int64())])
    schema = pa.schema([("number", pa.int64()), ("id", pa.int64()), ("label", pa.string()), ("v", pa.list_(pa.int64())),
                        ("windows", pa.list_(window))])
    some = blocks.where(F.exists("anchor", lambda a: a)).join(offsets, "part").select(
        "label", "start", "anchors_before", "ids", "anchor", "vectors")
    found = arrow_map(some, run, "number bigint, id bigint, label string, v array<bigint>, windows array<struct<low: bigint, high: bigint>>")
    return written(found.withColumn("tile", (F.col("number") / ANCHORS).cast("int")), "anchors"), total


class _Tile:
    """Anchors of a tile as arrays; windows past an anchor's last are empty."""

    def __init__(self, table: pa.Table, n_windows: int):
        self.number, self.id = (np.asarray(table.column(c).to_pylist(), np.int64) for c in ("number", "id"))
        self.label = np.array(table.column("label").to_pylist(), object)
        self.v = _matrix(table.column("v"))
        self.low = np.full((len(self.id), n_windows), _FAR, np.int64)
        self.high = np.full((len(self.id), n_windows), -_FAR, np.int64)
        for place, windows in enumerate(table.column("windows").to_pylist()):
            for w, window in enumerate(windows):
                self.low[place, w], self.high[place, w] = window["low"], window["high"]

    def must_read(self, label: str, low: np.ndarray, high: np.ndarray, same: bool) -> np.ndarray:
        """Which anchors have a window that the scores inside a zone may meet."""
        fits = (self.label == label) == same
        least, most = bounds(self.v[fits], low[None, :], high[None, :])
        meets = ((most >= self.low[fits]) & (least <= self.high[fits]) & (self.low[fits] <= self.high[fits])).any(axis=1)
        return np.flatnonzero(fits)[meets]


def _chosen(anchors: DataFrame, blocks: DataFrame, n_tiles: int, n_blocks: int, same: bool, n_windows: int) -> DataFrame:
    """(tile, block): the blocks that an anchor of the tile must read, from the zone maps alone."""
    parts = -(-n_blocks // ZONES)

    def run(key: tuple, mine: pa.Table, zones: pa.Table) -> pa.Table:
        tile, read = _Tile(mine, n_windows), []
        for z in zones.to_pylist() if mine.num_rows else ():
            if len(tile.must_read(z["label"], np.array(z["low"], np.int64), np.array(z["high"], np.int64), same)):
                read.append(z["block"])
        return pa.table({"tile": pa.array([key[0].as_py()] * len(read), pa.int32()), "block": pa.array(read, pa.int64())})

    zones = blocks.select("block", "label", "low", "high", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"),
                          F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))).alias("tile"))
    left = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return left.groupBy("tile", "part").cogroup(zones.groupBy("tile", "part")).applyInArrow(run, "tile int, block bigint")


def search(anchors: DataFrame, blocks: DataFrame, n_tiles: int, n_blocks: int, same: bool, n_windows: int, k: int) -> DataFrame:
    """number, window, rank (from 1), score, other: the first ``k`` rows in each window of each anchor.

    Rows are those of the anchor's own label, itself left out (``same``), or of every other label.
    """
    parts = -(-n_blocks // READ)

    def run(key: tuple, mine: pa.Table, read: pa.Table) -> pa.Table:
        tile = _Tile(mine, n_windows)
        none = np.empty(0, np.int64)
        best = [(none, none, none) for _ in range(n_windows)]  # anchor, score, id
        least = tile.low.copy()  # rises to the k-th best score of a window that has k
        for row in read.to_pylist() if mine.num_rows else ():
            ids = np.array(row["ids"], np.int64)
            v = _vectors(row["vectors"], len(ids))
            meet = tile.must_read(row["label"], np.array(row["low"], np.int64), np.array(row["high"], np.int64), same)
            for start in range(0, len(meet), SLICE):
                some = meet[start:start + SLICE]
                scores = products(tile.v[some], v)
                hits = (scores >= least[some].min(axis=1)[:, None]) & (scores <= tile.high[some].max(axis=1)[:, None])
                if same:
                    hits &= tile.id[some][:, None] != ids[None, :]
                at, column = np.nonzero(hits)
                score, who = scores[at, column].astype(np.int64), some[at]
                for w in range(n_windows):
                    inside = (score >= least[who, w]) & (score <= tile.high[who, w])
                    if inside.any():
                        known = [np.concatenate(x) for x in zip(best[w], (who[inside], score[inside], ids[column[inside]]))]
                        kept = first_of_each(*known, k)
                        a, s, i = best[w] = tuple(x[kept] for x in known)
                        full = np.flatnonzero(np.bincount(a, minlength=len(tile.id)) == k)
                        last = np.full(len(tile.id), _FAR, np.int64)
                        np.minimum.at(last, a, s)
                        least[full, w] = last[full]
        who, score, ids = (np.concatenate(x) for x in zip(*best, strict=True))
        window = np.repeat(np.arange(n_windows), [len(b[0]) for b in best])
        return pa.table({"number": pa.array(tile.number[who] if len(who) else none), "window": pa.array(window, pa.int32()),
                         "score": pa.array(score), "other": pa.array(ids)})

    chosen = _chosen(anchors, blocks, n_tiles, n_blocks, same, n_windows)
    read = blocks.select("block", "label", "low", "high", "ids", "vectors").join(chosen, "block").withColumn(
        "part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    left = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = left.groupBy("tile", "part").cogroup(read.groupBy("tile", "part")).applyInArrow(
        run, "number bigint, window int, score bigint, other bigint")
    first = F.row_number().over(W.partitionBy("number", "window").orderBy(F.desc("score"), "other"))
    return found.withColumn("rank", first).where(F.col("rank") <= k)


def mine_hard_negatives(
    rows: DataFrame, is_anchor: Column, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    scale: int = 256, n_positives: int = 5, n_negatives: int = 5, least_percent: int = 80,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's score is the inner product of its floor(scale * x) with the anchor's; higher scores come first, then smaller
    ids. An anchor's positives are its first ``n_positives`` other rows of its label. For each positive come the
    first ``n_negatives`` rows of other labels that score between ``least_percent`` of the positive's score and that
    score, both included; a positive of negative score therefore has none.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part. Rows equal in id, label
    and vector are one row; rows that share only the id are several, none a positive of another. Vectors of different
    lengths are compared as if the shorter one ended in zeros. No anchors or no rows give no rows. Components over
    2^27 after scaling and scores over 60 bits raise. Other columns are not looked at.
    """
    v = F.col(vector_column)
    kept = rows.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & v.isNotNull() & finite(v)).select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), whole_components(v, scale).alias("v"))
    blocks = write_blocks(kept)
    n_blocks = blocks.count()
    anchors, n_anchors = _anchors(blocks, n_positives) if n_blocks else (None, 0)
    if not n_anchors:
        return kept.sparkSession.createDataFrame([], (
            "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"))
    tiles = -(-n_anchors // ANCHORS)
    positives = search(anchors, blocks, tiles, n_blocks, True, 1, n_positives)
    of_anchor = positives.groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("other").alias("id"), "score"))).alias("positives"))

    def window(p: Column) -> Column:
        low = F.ceil(p["score"] * F.lit(least_percent).cast("decimal(3,0)") / 100).cast("bigint")
        return F.struct(low.alias("low"), p["score"].alias("high"))

    paired = written(anchors.drop("windows").join(of_anchor, "number").withColumn(
        "windows", F.transform("positives", window)), "anchor-windows")
    negatives = search(paired.drop("positives"), blocks, tiles, n_blocks, False, n_positives, n_negatives)
    named = paired.select("number", F.col("id").alias("anchor_id"), "positives")
    return negatives.join(named, "number").select(
        "anchor_id", F.get("positives", F.col("window"))["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), F.get("positives", F.col("window"))["score"].alias("positive_score"),
        F.col("score").alias("negative_score"))
