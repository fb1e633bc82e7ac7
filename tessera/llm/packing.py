"""Packing documents into fixed-length sequences by a plan over the histogram of their lengths.

Best-fit decreasing is run on (length, count) pairs, of which there are at most as many as the
capacity, and yields runs of slots. Documents then take slots by their rank within their length.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, rank_within, text_or_empty, texts_of, written
from tessera.llm.segments import SegmentCache, in_groups, segments

CAPACITY = 2048
END_ID = 0
#: Rows of one length that one task ranks.
RANKED_TOGETHER = 1_000_000


@dataclass(frozen=True)
class Run:
    """Slots of one length: rank r in [first, last) goes to sequence + (r - first) // each."""

    length: int
    first: int
    last: int
    each: int
    sequence: int
    offset: int


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best-fit decreasing over counts: the longest first, each into the fullest sequence that holds it.

    Sequences that are equally full are kept as ranges, so the work and the number of runs follow
    the number of lengths and not of documents.
    """
    runs: list[Run] = []
    room: list[int] = []  # sorted free space that occurs
    ranges: dict[int, list[tuple[int, int]]] = {}  # free space -> (first sequence, how many)
    opened = 0

    def keep(free: int, first: int, n: int) -> None:
        if n and free:
            if free not in ranges:
                insort(room, free)
            ranges.setdefault(free, []).append((first, n))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(room, length)
            if at < len(room):
                free = room[at]
                first, n = ranges[free].pop()
                if not ranges[free]:
                    del ranges[free], room[at]
            else:
                free, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = free // length
            whole = min(n, left // each)
            rest = min(left - whole * each, each - 1) if whole < n else 0
            placed = whole * each + rest
            runs.append(Run(length, rank, rank + placed, each, first, capacity - free))
            keep(free - each * length, first, whole)
            if rest:
                keep(free - rest * length, first + whole, 1)
            used = whole + bool(rest)
            keep(free, first + used, n - used)
            rank, left = rank + placed, left - placed
    return runs


@lru_cache(maxsize=4)
def encoders(path: str):
    """The library's tokenizer and, for text without rare scripts, a quicker one with the same vocabulary."""
    import json

    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    spec = json.load(open(path, encoding="utf-8"))
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    alike = (model["type"] == "BPE" and spec.get("normalizer") is None and before.get("type") == "ByteLevel"
             and not before.get("add_prefix_space") and before.get("use_regex", True)
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")))
    if not alike:
        return exact, None
    # the quicker one merges in the order of the ids
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [model["vocab"][a + b] for a, b in merges]
    if any(b <= a for a, b in zip(merged, merged[1:])):
        return exact, None
    shown = byte_symbols()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(shown[c] for c in token): n for token, n in model["vocab"].items() if token not in special}
    # fixed value: the pattern of this pre-tokenizer
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return exact, tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def segment_ids(path: str) -> SegmentCache:
    """Ids of segments, kept by the worker process."""
    return SegmentCache(id_bytes_of(path), limit=300_000)


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is visible."""
    seen = [b for b in range(256) if chr(b).isprintable() and chr(b) not in (" ", "\xa0", "\xad")]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(hidden)}


def id_bytes_of(path: str):
    """A function from segments to their ids as little-endian unsigned 32-bit integers.

    Usual segments are encoded as one text, in which every segment starts at a token boundary, and
    the ids are cut by the lengths of their tokens; others go to the library one by one.
    """
    import numpy as np

    exact, quick = encoders(path)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    # scripts outside these ranges may be classified differently by other Unicode versions
    odd = re.compile("|".join([r"[^\x00-\u024f\u2018-\u201f]", r"[\x1c-\x1f\x85]", *map(re.escape, special)]))
    token_bytes = None
    if quick is not None:
        token_bytes = np.zeros(quick.n_vocab, dtype=np.int64)
        for n in range(quick.n_vocab):
            token_bytes[n] = len(quick.decode_single_token_bytes(n))

    def encode(found: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(found)
        usual, single, rare = [], [], []
        all_usual = quick is not None and odd.search("".join(found)) is None
        for n, s in enumerate(found):
            if not (all_usual or quick is not None and odd.search(s) is None):
                rare.append(n)
            elif len(s) > 1 and s[0] == " " and not s[-1].isspace():
                usual.append(n)
            else:
                single.append(n)
        for n, e in zip(rare, exact.encode_batch([found[n] for n in rare], add_special_tokens=False), strict=True):
            out[n] = np.array(e.ids, dtype="<u4").tobytes()
        for n in single:
            out[n] = np.array(quick.encode_ordinary(found[n]), dtype="<u4").tobytes()
        if usual:
            ids = np.array(quick.encode_ordinary("".join([found[n] for n in usual])), dtype="<u4")
            ends = np.cumsum([len(found[n].encode()) for n in usual])
            cuts = (np.searchsorted(np.cumsum(token_bytes[ids]), ends) + 1).tolist()
            data, at = ids.tobytes(), 0
            for n, cut in zip(usual, cuts, strict=True):
                out[n] = data[4 * at:4 * cut]
                at = cut
        return out

    return encode


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of ``capacity``; the first may be shorter."""

    def make():
        cache = segment_ids(tokenizer_path)
        end = end_id.to_bytes(4, "little")

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list] = [[], [], [], [], []]
            texts = texts_of(batch)
            ids = iter(batch.column("doc_id").to_pylist())
            for group in in_groups(texts):
                parts = [segments(t) if t else [] for t in group]
                known = cache.look_up(parts)
                for p in parts:
                    doc_id, data = next(ids), b"".join(map(known.__getitem__, p)) + end
                    n = len(data) // 4
                    first = (n - 1) % capacity + 1
                    for k, at in enumerate([0, *range(first, n, capacity)]):
                        length = first if k == 0 else capacity
                        for column, value in zip(
                                out, (doc_id, k, at, length, zlib.crc32(data[4 * at:4 * (at + length)])), strict=True):
                            column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, make, PIECES)


def assign_slots(pieces: DataFrame, capacity: int = CAPACITY, together: int = RANKED_TOGETHER) -> DataFrame:
    """``pieces`` with sequence_id and offset; a length with many rows is ranked in salted parts."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan_slots(histogram, capacity)
    planned = spark.createDataFrame(
        [(r.length, r.first, r.last, r.each, r.sequence, r.offset) for r in runs],
        "length bigint, r_first bigint, r_last bigint, r_each bigint, r_sequence bigint, r_offset bigint")
    parts = spark.createDataFrame([(k, -(-n // together)) for k, n in histogram.items()], "length bigint, n_parts bigint")
    # both tables have at most a few rows for each possible length, whatever the input
    ranked = rank_within(pieces, "length", parts, ["doc_id", "piece"])
    slot = F.col("rank") - F.col("r_first")
    return ranked.join(
        F.broadcast(planned),
        (ranked["length"] == planned["length"]) & (F.col("rank") >= F.col("r_first")) & (F.col("rank") < F.col("r_last")),
    ).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("r_sequence") + F.floor(slot / F.col("r_each"))).cast("long").alias("sequence_id"),
        (F.col("r_offset") + slot % F.col("r_each") * ranked["length"]).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and the end id, so a null or empty text is one piece of length 1. Only
    longer documents are cut; every piece is in exactly one sequence and the pieces of a sequence
    fill it without gaps from 0. Equal lengths are ranked by doc_id and piece; repeated rows get
    slots of their own in any order. An empty table gives an empty result; extra columns are ignored.
    """
    return assign_slots(written(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces"), capacity)
