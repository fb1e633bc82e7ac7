"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts go whole into shards. Groups that weigh something against a shard are packed
one by one; the many light ones are first bundled by their hash. There are at most ``2 * n_shards *
parts`` such units, whatever the input, and best fit sees each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import rank_within, text_or_empty, written

N_SHARDS = 40
PARTS = 256
ROW_BYTES = 16
RANKED_TOGETHER = 1_000_000


class RoomTree:
    """Balanced search tree (AVL) of (free space, bin); finds the tightest bin that holds an item."""

    def __init__(self):
        self._root = None

    def insert(self, key: tuple[int, int]) -> None:
        self._root = self._insert(self._root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self._root = self._remove(self._root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        node, best = self._root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best

    # a node is [key, smaller, larger, height]
    def _settle(self, node):
        def height(x):
            return x[3] if x else 0

        def turn(x, up, down):
            y = x[up]
            x[up], y[down] = y[down], x
            x[3] = 1 + max(height(x[1]), height(x[2]))
            y[3] = 1 + max(height(y[1]), height(y[2]))
            return y

        lean = height(node[1]) - height(node[2])
        if abs(lean) > 1:
            up, down = (1, 2) if lean > 0 else (2, 1)
            if height(node[up][down]) > height(node[up][up]):
                node[up] = turn(node[up], down, up)
            return turn(node, up, down)
        node[3] = 1 + max(height(node[1]), height(node[2]))
        return node

    def _insert(self, node, key):
        if node is None:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self._insert(node[side], key)
        return self._settle(node)

    def _remove(self, node, key):
        if key != node[0]:
            side = 1 if key < node[0] else 2
            node[side] = self._remove(node[side], key)
        elif node[1] is None or node[2] is None:
            return node[1] or node[2]
        else:
            least = node[2]
            while least[1]:
                least = least[1]
            node[0] = least[0]
            node[2] = self._remove(node[2], least[0])
        return self._settle(node)


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; larger items first, each into the bin with the least room that holds it."""
    tree, bins, opened = RoomTree(), [0] * len(sizes), 0
    for n in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        found = tree.tightest(sizes[n])
        if found:
            tree.remove(found)
            free, place = found
        else:
            if sizes[n] > capacity:
                raise ValueError(f"an item of {sizes[n]} exceeds the capacity {capacity}")
            free, place = capacity, opened
            opened += 1
        bins[n] = place
        tree.insert((free - sizes[n], place))
    return bins


def least_capacity(sizes: list[int], n_bins: int, steps: int = 16) -> tuple[int, list[int]]:
    """The least capacity found by halving with which best fit needs ``n_bins`` bins at most."""
    low = max(-(-sum(sizes) // n_bins), max(sizes, default=0), 1)
    high = 2 * low  # best fit decreasing never needs more
    best = best_fit_decreasing(sizes, high)
    for _ in range(steps):
        if low >= high:
            break
        middle = (low + high) // 2
        bins = best_fit_decreasing(sizes, middle)
        if max(bins, default=-1) < n_bins:
            high, best = middle, bins
        else:
            low = middle + 1
    return high, best


def spread(sizes: list[int], n_bins: int) -> list[int]:
    """Bin of each item: those above an equal share get a bin of their own, the others the remaining bins.

    What is left then has a smaller share, so this repeats until no item is above it; best fit packs
    the rest with a capacity of its own.
    """
    bins, rest, left = [0] * len(sizes), sum(sizes), n_bins
    order = sorted(range(len(sizes)), key=lambda k: -sizes[k])
    alone = 0
    while left > 1 and alone < len(order) and sizes[order[alone]] * left > rest:
        bins[order[alone]] = alone
        rest -= sizes[order[alone]]
        alone, left = alone + 1, left - 1
    others = sorted(order[alone:])
    _, packed = least_capacity([sizes[k] for k in others], left)
    for k, place in zip(others, packed, strict=True):
        bins[k] = alone + place
    return bins


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, parts: int = PARTS,
                    together: int = RANKED_TOGETHER) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: shard sizes near equal, groups of equal texts undivided. A group above an
    equal share has a shard of its own; for the others the capacity is the least with which best fit
    needs no more than the remaining shards. A null text counts as empty and
    weighs 16 bytes. Rows of one shard are numbered without gaps from 0; repeated rows get slots of
    their own. An empty table gives an empty result; extra columns are ignored. ``grown_shard`` is
    null under this law.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("content")), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    n_bundles = n_shards * parts
    # fewer than n_bundles groups can weigh more than their share of the total
    heavy = [bytes(r[0]) for r in rows.groupBy("content").agg(F.sum("size").alias("weight"))
             .where(F.col("weight") > total / n_bundles).select("content").collect()]
    named = spark.createDataFrame([(c, n_bundles + k) for k, c in enumerate(sorted(heavy))], "content binary, heavy bigint")
    rows = rows.join(F.broadcast(named), "content", "left").withColumn(
        "unit", F.coalesce("heavy", F.pmod(F.xxhash64("content"), F.lit(n_bundles)))).drop("heavy", "content")
    units = sorted(tuple(r) for r in rows.groupBy("unit").agg(F.sum("size"), F.count(F.lit(1))).collect())
    bins = spread([size for _, size, _ in units], n_shards)
    filled = [0] * n_shards
    plan = []
    for (unit, _, n), shard in zip(units, bins, strict=True):
        plan.append((unit, shard, filled[shard], -(-n // together)))
        filled[shard] += n
    placed = spark.createDataFrame(plan, "unit bigint, shard int, first_slot bigint, n_parts bigint")
    ranked = rank_within(rows, "unit", placed.select("unit", "n_parts"), ["doc_id", "text_crc32", "size"])
    return ranked.join(F.broadcast(placed.drop("n_parts")), "unit").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first_slot") + F.col("rank")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
