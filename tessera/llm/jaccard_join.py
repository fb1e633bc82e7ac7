"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

Rows are the distinct shingle sets, columns the shingles, dealt over tasks in blocks of columns.
With the columns of each row ordered from rare to frequent, a pair that reaches the threshold
shares one of the leading columns of both, so only those are multiplied; and where a shared column
stands in both rows bounds what can still be shared. Pairs below the bound that their sizes set are
discarded, the others get their whole row product if sketches of both rows, which bound from below in
how many columns they differ, leave the threshold possible.

The product runs twice. First each column multiplies with its leading row only, and each row keeps
the leading row that it meets most often, which links most of a large group of near copies through
one pair a row; then all rows of a column, without pairs that are
in one component already or that the bounds exclude. Both together lose no link between components.

All links lie inside components, so they are counted there: the rows of a component are dealt into
blocks, and each pair of blocks is one product of whole rows that gives every overlap between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, in_text_groups, text_or_empty, written
from tessera.llm.components import connected_components

#: Cells of the table of shingle frequencies that every task gets (4 bytes each).
CELLS = 1 << 20
#: Bits of the filter that finds the texts to compare (4 MB, whatever the input).
FILTER_BITS = 1 << 25

#: Rows, and shingles, of a component that are one block of the product which counts links.
TILE_ROWS = 512
TILE_SHINGLES = 2_000_000
#: Columns of a dense product.
DENSE_COLUMNS = 4096

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class WordHashes(dict):
    """64-bit hashes of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Sorted 64-bit hashes of a text's distinct n-word shingles; words by ASCII white space, A-Z lowered."""

    def __init__(self, n: int, kept_words: int = 300_000):
        self.n, self.kept_words = n, kept_words
        self.hashes = WordHashes()

    def words(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if len(self.hashes) > self.kept_words:
            self.hashes = WordHashes()
        return np.fromiter(map(self.hashes.__getitem__, words), dtype=np.uint64, count=len(words))

    def __call__(self, text: str) -> np.ndarray:
        w = self.words(text)
        n = min(self.n, len(w))
        if n == 0:
            return w
        h = np.full(len(w) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ (h >> np.uint64(31))) * _ODD[0] + w[k:len(w) - n + 1 + k]
        h = (h ^ (h >> np.uint64(29))) * _ODD[1]
        h ^= h >> np.uint64(32)
        h.sort()
        return h[np.concatenate(([True], h[1:] != h[:-1]))]


def set_digest(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def half_of(node: bytes) -> np.int64:
    """The first 64 bits of a set digest, as Spark reads them from its hex digits."""
    return np.frombuffer(node, dtype=">i8", count=1)[0].astype(np.int64)


def parity_sketch(grams: np.ndarray) -> bytes:
    """Whether an odd number of the shingles falls on each of as many bits, the next power of two."""
    bits = max(64, 1 << (len(grams) - 1).bit_length())
    return np.packbits(np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) % 2 == 1).tobytes()


def may_link(percent: int, sketch_a: bytes, size_a: int, sketch_b: bytes, size_b: int) -> bool:
    """Whether sets with these sketches can reach the threshold.

    A shingle that one set alone has flips one bit, so the sets differ in as many shingles as their sketches
    in bits, at least. The longer sketch is folded to the other's length.
    """
    a, b = np.frombuffer(sketch_a, dtype=np.uint8), np.frombuffer(sketch_b, dtype=np.uint8)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    differ = int(np.bitwise_count(a ^ b).sum())
    return (size_a + size_b - differ) * (100 + percent) >= 2 * percent * (size_a + size_b)


def needed_share(percent: int, size: np.ndarray | int) -> int:
    """Least overlap of a set of ``size`` with any set that reaches the threshold."""
    return -(-percent * size // 100)


# ------------------------------------------------------------- passes over the texts

def _summaries(docs: DataFrame, n: int) -> DataFrame:
    """Rows of two kinds: a document's set size, set digest and sketch; a cell's count of repeated shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        cells = np.zeros(CELLS, dtype=np.int64)
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("sketch", pa.binary()),
                            ("cell", pa.int32()), ("n", pa.int64())])
        for ids, texts in in_text_groups(batches):
            sizes, nodes, sketches, own = [], [], [], {}
            for t in texts:
                grams = shingle(t)
                node = set_digest(grams) if len(grams) else None
                if node:
                    own.setdefault(node, grams)
                sizes.append(len(grams))
                nodes.append(node)
                sketches.append(parity_sketch(grams) if node else None)
            if own:
                # shingles that several sets of these texts have; the others would only add noise
                grams, counts = np.unique(np.concatenate(list(own.values())), return_counts=True)
                more = counts > 1
                np.add.at(cells, grams[more].astype(np.int64) & (CELLS - 1), counts[more])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(sketches, pa.binary()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.int64())], schema=schema)
        used = np.flatnonzero(cells)
        for part in np.array_split(used, max(1, len(used) // 50_000)):
            if len(part):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.binary()),
                     pa.nulls(len(part), pa.binary()), pa.array(part.astype(np.int32)), pa.array(cells[part])], schema=schema)

    return arrow_map(docs, run, "doc_id bigint, n_shingles bigint, node binary, sketch binary, cell int, n bigint")


def _leading_columns(docs: DataFrame, n: int, percent: int, frequency) -> DataFrame:
    """(gram, half, size, pos) for the leading shingles of each distinct set, rare ones first; half the digest names the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, seen = Shingler(n), set()
        of_cell = frequency.value
        for _, texts in in_text_groups(batches, most=4_000_000):
            gram_parts, halves, sizes, positions = [], [], [], []
            for t in texts:
                grams = shingle(t)
                size = len(grams)
                if not size or (node := set_digest(grams)) in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(node)
                lead = size - needed_share(percent, size) + 1
                often = of_cell[grams.astype(np.int64) & (CELLS - 1)]
                # the hash breaks ties, and grams are sorted by it
                gram_parts.append(grams[np.argsort(often, kind="stable")[:lead]])
                halves.append(np.full(lead, half_of(node)))
                sizes.append(np.full(lead, size, dtype=np.int32))
                positions.append(np.arange(lead, dtype=np.int32))
            if halves:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(gram_parts).view(np.int64)), pa.array(np.concatenate(halves)),
                     pa.array(np.concatenate(sizes)), pa.array(np.concatenate(positions))],
                    names=["gram", "half", "size", "pos"])

    return arrow_map(docs, run, "gram bigint, half bigint, size int, pos int")


def _wanted_texts(docs: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """(doc_id, node, text) of the documents whose id a fixed-size bit table of ``wanted`` (id) may hold."""
    spark = docs.sparkSession
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)) + 1
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    marked = wanted.select(cell.alias("cell")).groupBy(F.call_function("bitmap_bucket_number", "cell").alias("bucket")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", "cell")).alias("bits"))
    for row in marked.collect():  # at most FILTER_BITS / 32768 rows of 4 KB
        at = (row["bucket"] - 1) * 4096
        bits[at:at + 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    table = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in batches:
            at = batch.column("cell").to_numpy(zero_copy_only=False) - 1
            hit = np.flatnonzero(table.value[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            some = batch.take(pa.array(hit))
            if some.num_rows:
                nodes = [set_digest(shingle(t)) for t in some.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(nodes, pa.binary()), some.column("text")], names=["doc_id", "node", "text"])

    return arrow_map(docs.select("doc_id", "text", cell.alias("cell")), run, "doc_id bigint, node binary, text string")


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose sketches leave the threshold possible, so that few others have their texts compared."""
    of = nodes.select("rep", "sketch", "size")
    both = pairs.join(of.toDF("a", "sketch_a", "size_a"), "a").join(of.toDF("b", "sketch_b", "size_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(c).to_pylist() for c in ("sketch_a", "size_a", "sketch_b", "size_b")]
            keep = [k for k, side in enumerate(zip(*sides, strict=True)) if may_link(percent, *side)]
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep))

    # an id with several sets has a row for each
    return written(arrow_map(both.select("a", "b", "sketch_a", "size_a", "sketch_b", "size_b"), run, "a bigint, b bigint").distinct(), "near")


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose whole sets reach the threshold."""
    pairs = _near(pairs, nodes, percent)
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    wanted = written(ends.join(nodes.select(F.col("rep").alias("doc_id"), "node"), "doc_id"), "compare")
    # the bit table may let others pass; the join does not
    texts = written(_wanted_texts(docs, n, wanted).join(wanted, ["doc_id", "node"], "left_semi").select("doc_id", "text"), "texts")
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in batches:
            keep, last, grams_b = [], None, None
            for k, (x, y) in enumerate(zip(batch.column("text_a"), batch.column("text_b"), strict=True)):
                text_b = y.as_py()
                if text_b != last:
                    last, grams_b = text_b, shingle(text_b)
                grams_a = shingle(x.as_py())
                shared = len(np.intersect1d(grams_a, grams_b, assume_unique=True))
                if shared * (100 + percent) >= percent * (len(grams_a) + len(grams_b)):
                    keep.append(k)
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep))

    return arrow_map(both.select("a", "b", "text_a", "text_b"), run, "a bigint, b bigint").distinct()


# ------------------------------------------------------------- counting links inside components

def overlaps(sets: list[np.ndarray], n_left: int) -> np.ndarray:
    """How many shingles each of the first ``n_left`` sets shares with each of the others."""
    m = len(sets)
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    owner = np.repeat(np.arange(m), [len(g) for g in sets])[order]
    grams = grams[order]
    starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    counts = np.diff(np.append(starts, len(grams)))
    # owners of a column ascend, so its first and last tell whether it is on both sides
    both = (owner[starts] < n_left) & (owner[starts + counts - 1] >= n_left)
    starts, counts = starts[both], counts[both]
    out = np.zeros(m * m, dtype=np.int64)
    few = counts * 6 < m
    for c in np.unique(counts[few]):
        rows = owner[starts[few & (counts == c)][:, None] + np.arange(c)]
        for k in range(c - 1):
            out += np.bincount((rows[:, k, None] * m + rows[:, k + 1:]).ravel(), minlength=m * m)
    out = out.reshape(m, m)[:n_left, n_left:]
    starts, counts = starts[~few], counts[~few]
    for at in range(0, len(starts), DENSE_COLUMNS):
        first, width = starts[at:at + DENSE_COLUMNS], counts[at:at + DENSE_COLUMNS]
        column = np.repeat(np.arange(len(first)), width)
        place = np.arange(len(column)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first, width)
        dense = np.zeros((m, len(first)), dtype=np.float32)
        dense[owner[place], column] = 1
        out = out + (dense[:n_left] @ dense[n_left:].T).astype(np.int64)
    return out


def tile_counts(left: list[tuple], right: list[tuple] | None, percent: int) -> Iterator[tuple[bytes, int]]:
    """(node, copies of the sets it links with) of (node, copies, shingles); without ``right``, among ``left``."""
    alone = right is None
    other = left if alone else right
    if not left or not other:
        return
    shared = overlaps([g for _, _, g in left] + [g for _, _, g in other], len(left))
    size_l, size_r = (np.array([len(g) for _, _, g in side], dtype=np.int64) for side in (left, other))
    link = shared * (100 + percent) >= percent * (size_l[:, None] + size_r[None, :])
    if alone:
        np.fill_diagonal(link, False)
    copies_l, copies_r = (np.array([c for _, c, _ in side], dtype=np.int64) for side in (left, other))
    yield from ((node, int(c)) for (node, _, _), c in zip(left, link @ copies_r, strict=True) if c)
    if not alone:
        yield from ((node, int(c)) for (node, _, _), c in zip(other, copies_l @ link, strict=True) if c)


def _linked_copies(docs: DataFrame, members: DataFrame, n: int, percent: int, tile_rows: int, tile_shingles: int) -> DataFrame:
    """(node, linked): copies of all other sets that each set of ``members`` links with, where there are any.

    ``members`` has node, rep, size, copies and component. A component of ``k`` blocks has a tile for
    each pair of blocks, and for each block with itself; a row goes to ``k`` tiles, so no task holds
    more than two blocks.
    """
    totals = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight")).where("n > 1").select(
        "component", F.greatest(F.ceil(F.col("n") / tile_rows), F.ceil(F.col("weight") / tile_shingles)).cast("int").alias("k"))
    dealt = written(members.join(totals, "component").select(
        F.col("rep").alias("doc_id"), "node", "copies", "component", "k",
        F.pmod(F.xxhash64("node"), F.col("k")).cast("int").alias("block")), "blocks")
    texts = _wanted_texts(docs, n, dealt.select("doc_id")).join(dealt, ["doc_id", "node"])
    tiles = texts.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "copies", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        key, sides = None, ({}, {})

        def counted() -> list[tuple[bytes, int]]:
            left, right = (list(side.values()) for side in sides)
            return list(tile_counts(left, right if key[1] != key[2] else None, percent)) if key else []

        def batch_of(found: list[tuple[bytes, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.binary()), pa.array([c for _, c in found], pa.int64())], names=["node", "linked"])

        for batch in batches:
            found = []
            names = [batch.column(c).to_pylist() for c in ("component", "i", "j", "block", "node", "copies")]
            for component, i, j, block, node, copies, text in zip(*names, batch.column("text"), strict=True):
                if (component, i, j) != key:
                    found += counted()
                    key, sides = (component, i, j), ({}, {})
                side = sides[block != i]
                if node not in side:  # rows repeated with their id and text
                    side[node] = (node, copies, shingle(text.as_py()))
            yield batch_of(found)
        yield batch_of(counted())

    dealt_out = tiles.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return arrow_map(dealt_out, run, "node binary, linked bigint").groupBy("node").agg(F.sum("linked").alias("linked"))


# ------------------------------------------------------------- the product

def _may_reach(percent: int, size_a: Column, pos_a: Column, size_b: Column, pos_b: Column) -> Column:
    """Whether two rows that share a column at these positions can still reach the threshold."""
    most = F.least(size_a - pos_a, size_b - pos_b)
    return most * (100 + percent) >= (size_a + size_b) * percent


def _components(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node) of every row, and (node, rep, component_id) of every set that an id has."""
    spark = docs.sparkSession
    both = written(_summaries(docs, n), "sets")
    sets = both.where("cell is null").select("doc_id", "n_shingles", "node", "sketch")
    counted = both.where("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most CELLS rows
    frequency = np.zeros(CELLS, dtype=np.int64)
    frequency[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    frequency = spark.sparkContext.broadcast(np.minimum(frequency, 2**31 - 1).astype(np.int32))
    nodes = written(sets.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("size"), F.any_value("sketch").alias("sketch")).where(
        "rep is not null"), "nodes")

    # entries of columns that more than one row has, rows named by their smallest document
    entries = written(_leading_columns(docs, n, percent, frequency), "columns")
    shared = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gram")
    entries = entries.join(shared, "gram", "left_semi")
    # sets that have half a digest in common get each other's entries too, which only adds pairs to compare
    halves = nodes.select(F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("bigint").alias("half"), "rep")
    entries = written(
        entries.join(halves, "half").groupBy("gram", "rep").agg(F.min("size").alias("size"), F.min("pos").alias("pos")), "entries")

    leaders = entries.groupBy("gram").agg(F.min(F.struct("pos", "size", "rep")).alias("lead"), F.count(F.lit(1)).alias("k"))
    near_lead = entries.join(leaders.where("k > 1"), "gram").where(
        (F.col("rep") != F.col("lead.rep"))
        & _may_reach(percent, F.col("size"), F.col("pos"), F.col("lead.size"), F.col("lead.pos")))
    # of the leading rows that a row meets, the one it shares most columns with
    met = near_lead.groupBy("rep", F.col("lead.rep").alias("lead")).agg(F.count(F.lit(1)).alias("shared"))
    first = met.groupBy("rep").agg(F.max_by("lead", F.struct("shared", "lead")).alias("lead"))
    first_pairs = written(
        first.select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct(), "pairs")
    links = written(_linked(first_pairs, docs, nodes, n, percent), "links")
    found = connected_components(links, "a", "b")

    # now every row of a column, across components
    reach = F.floor((F.col("size") - F.col("pos")) * (100 + percent) / percent) - F.col("size")
    grouped = written(
        entries.join(found.withColumnRenamed("id", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")).withColumn("reach", reach), "entries")
    sizes = grouped.groupBy("gram", F.col("size").alias("s")).agg(
        F.max("reach").alias("s_reach"), F.min("component").alias("c_min"), F.max("component").alias("c_max"))
    active = grouped.join(
        sizes, (grouped["gram"] == sizes["gram"]) & (F.col("s") <= F.col("reach")) & (F.col("size") <= F.col("s_reach"))
        & ((F.col("c_min") != F.col("component")) | (F.col("c_max") != F.col("component"))), "left_semi")
    active = written(active, "active")
    x, y = (active.select(F.col("gram"), *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "size", "pos", "component")])
            for side in "ab")
    product = x.join(y, "gram").where(
        (F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b"))
        & _may_reach(percent, F.col("size_a"), F.col("pos_a"), F.col("size_b"), F.col("pos_b")))
    overlap = product.groupBy(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).agg(
        F.count(F.lit(1)).alias("shared"), F.max("pos_a").alias("pos_a"), F.max("pos_b").alias("pos_b"),
        F.max("size_a").alias("size_a"), F.max("size_b").alias("size_b"))
    rest = F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b")) - 1
    second_pairs = written(
        overlap.where((F.col("shared") + rest) * (100 + percent) >= (F.col("size_a") + F.col("size_b")) * percent)
        .select("a", "b").join(first_pairs, ["a", "b"], "left_anti"), "pairs")
    more = _linked(second_pairs, docs, nodes, n, percent)
    components = connected_components(links.union(more), "a", "b")

    named = nodes.join(components.withColumnRenamed("id", "rep"), "rep", "left").select(
        "node", "rep", F.coalesce("component", "rep").alias("component_id"))
    return sets.drop("sketch"), named


def similar_documents(docs: DataFrame, n: int = 3, percent: int = 90, tile_rows: int = TILE_ROWS,
                      tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_links.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of n-word
    shingles; with fewer words the whole sequence is the one shingle. Null, empty and blank texts
    have no shingles and link with nothing. ``component_id`` is the smallest doc_id reachable by
    links, the own one included. Shingles are compared by 64-bit and sets by 128-bit hashes. Rows
    with equal sets are one row of the matrix; documents that share an id count as one in components.
    ``n_links`` is the number of other documents that the row's one links with, copies included; rows
    repeated with their id and set are one document, an id with several sets is one for each, and rows
    without an id are not counted: theirs is null. A null id never names a component unless its text
    has no other. Extra columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sets, named = _components(docs, n, percent)
    copies = sets.where("node is not null").groupBy("node").agg(
        F.max("n_shingles").alias("size"), F.countDistinct("doc_id").alias("copies"))
    members = written(named.join(copies, "node").withColumnRenamed("component_id", "component"), "members")
    linked = _linked_copies(docs, members, n, percent, tile_rows, tile_shingles)
    counted = members.join(linked, "node", "left").select(
        "node", F.col("component").alias("component_id"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return sets.join(counted, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0))).cast("long").alias("n_links"))


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near copies, the one with the smallest id; all columns as they came.

    Documents without shingles stay, and so do rows with a null id. Of rows repeated with their id and text all stay.
    """
    sets, named = _components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), n, percent)
    gone = sets.join(named, "node").where("component_id != doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), F.struct("*").alias("__row"))
    return rows.join(gone, F.col("__id") == F.col("__gone"), "left_anti").select("__row.*")
