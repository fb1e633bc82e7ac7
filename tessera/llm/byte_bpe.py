"""Byte-level BPE encoding and decoding in two tiers.

Tier one: a minimal perfect hash over the vocabulary resolves pre-tokens that are one token.
Tier two: other pre-tokens are merged by a heap of candidate pairs over a linked list of bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, text_or_empty, texts_of
from tessera.llm.segments import SegmentCache, in_groups, segments


class PerfectHash:
    """Minimal perfect hash by displacement: each of n keys has its own slot in 0 .. n-1.

    Keys fall into buckets; larger buckets first, each takes the first displacement that puts its
    keys on free slots. A slot stores its key, so foreign keys are told apart by one comparison.
    """

    def __init__(self, values: dict[bytes, int], per_bucket: int = 3):
        n = len(values)
        self.size, self.n_buckets = n, max(1, n // per_bucket)
        keys = list(values)
        buckets: list[list[tuple[int, int, int]]] = [[] for _ in range(self.n_buckets)]
        for number, key in enumerate(keys):
            bucket, a, b = self._hashes(key)
            buckets[bucket].append((a, b, number))
        self.shift = [0] * self.n_buckets
        slots: list[int | None] = [None] * n
        order = sorted(range(self.n_buckets), key=lambda k: -len(buckets[k]))
        for bucket in order:
            members, d = buckets[bucket], 0
            if len(members) < 2:
                break
            while True:
                places = [self._place(a, b, d) for a, b, _ in members]
                if len(set(places)) == len(places) and all(slots[p] is None for p in places):
                    break
                d += 1
            self.shift[bucket] = d
            for p, (_, _, number) in zip(places, members, strict=True):
                slots[p] = number
        # a bucket of one key names its slot outright, as a negative displacement
        free = (p for p in range(n) if slots[p] is None)
        for bucket in order:
            if len(buckets[bucket]) == 1:
                p = next(free)
                self.shift[bucket], slots[p] = -1 - p, buckets[bucket][0][2]
        self.keys = [keys[k] for k in slots]
        self.values = [values[k] for k in self.keys]

    def _hashes(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return (h & 0xFFFFFFFF) % self.n_buckets, (h >> 32) & 0xFFFFFFFF, h >> 64

    def _place(self, a: int, b: int, d: int) -> int:
        if d < 0:
            return -1 - d
        # with the second hash multiplied and mixed, displacements act like independent draws
        x = (a + d * 0x9E3779B97F4A7C15 ^ (b + d)) & 0xFFFFFFFFFFFFFFFF
        return (x * 0xD6E8FEB86659FD93 >> 24 & 0xFFFFFFFFFF) % self.size

    def get(self, key: bytes) -> int | None:
        bucket, a, b = self._hashes(key)
        slot = self._place(a, b, self.shift[bucket])
        return self.values[slot] if self.keys[slot] == key else None


class ByteBpe:
    """Encoder and decoder of one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_limit: int = 300_000):
        import regex

        self.memo: dict[str, tuple[int, ...]] = {}
        self.old_memo: dict[str, tuple[int, ...]] = {}
        self.memo_limit = memo_limit
        self.ranks = ranks
        self.whole = PerfectHash(ranks)
        self.bytes_of = {n: token for token, n in ranks.items()}
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        # two ids -> the id of their bytes together, which is also its rank: every way to cut every token in two
        self.joined = {(a, b): n for token, n in ranks.items() for cut in range(1, len(token))
                       if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None}
        self.split = regex.compile(pattern).findall

    def merge(self, token: bytes) -> list[int]:
        """Ids of a pre-token: the adjacent pair of lowest rank merges first, the left one on ties."""
        symbol = [*map(self.byte_ids.__getitem__, token)]
        n, joined, push, pop = len(symbol), self.joined.get, heapq.heappush, heapq.heappop
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        pair = [*map(joined, zip(symbol, symbol[1:])), None]  # what the part that starts here and the next join to
        bits = n.bit_length()
        low = (1 << bits) - 1
        heap = [new << bits | i for i, new in enumerate(pair) if new is not None]
        heapq.heapify(heap)
        while heap:
            entry = pop(heap)
            i, new = entry & low, entry >> bits
            if pair[i] != new:
                continue  # one of the two has changed since
            j, h = after[i], before[i]
            k = after[j]
            symbol[i], symbol[j] = new, -1
            after[i] = k
            pair[i] = pair[j] = None
            if k < n:
                before[k] = i
                pair[i] = found = joined((new, symbol[k]))
                if found is not None:
                    push(heap, found << bits | i)
            if h >= 0:
                pair[h] = found = joined((symbol[h], new))
                if found is not None:
                    push(heap, found << bits | h)
        return [s for s in symbol if s >= 0]

    def encode_part(self, part: str) -> tuple[int, ...]:
        """Ids of one pre-token, kept for the next time; a full memo becomes the old one, which the next replaces."""
        ids = self.memo.get(part)
        if ids is None:
            ids = self.old_memo.get(part)
            if ids is None:
                token = part.encode()
                found = self.whole.get(token)
                ids = tuple(self.merge(token)) if found is None else (found,)
            if len(part) <= 48:
                if len(self.memo) >= self.memo_limit:
                    self.memo, self.old_memo = {}, self.memo
                self.memo[part] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.split(text):
            out += self.encode_part(part)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def never_joins_over_space(pattern: str) -> bool:
    """Whether pre-tokens end before every space that follows another character than white space."""
    # fixed value: the pattern for which this holds, since white space stands only at the start of its branches
    return pattern == r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def load_bpe(path: str, pattern: str) -> ByteBpe:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(n) for token, n in map(bytes.split, lines)}
    return ByteBpe(ranks, pattern)


@lru_cache(maxsize=2)
def digest_parts(path: str, pattern: str) -> SegmentCache:
    """Per segment: the decimal names of its ids, comma-joined, and their decoding. Kept by the worker process."""
    bpe = load_bpe(path, pattern)
    name_of = [str(n) for n in range(max(bpe.bytes_of) + 1)]

    def values(found: list[str]) -> list[tuple[str, bytes]]:
        every = map(bpe.encode, found)
        return [(",".join([name_of[i] for i in ids]), bpe.decode(ids)) for ids in every]

    return SegmentCache(values, limit=200_000)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array of int) of the whole text. Null texts have no ids."""

    def make():
        bpe = load_bpe(ranks_path, pattern)
        cache = SegmentCache(lambda found: [np.array(bpe.encode(s), "<i4").tobytes() for s in found], limit=300_000)
        cut = segments if never_joins_over_space(pattern) else lambda t: [t]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data = []
            for group in in_groups(texts_of(batch)):
                parts = [cut(t) if t else [] for t in group]
                known = cache.look_up(parts)
                data += [b"".join(map(known.__getitem__, p)) for p in parts]
            ends = np.cumsum([0, *(len(d) // 4 for d in data)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4")))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, make, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per row of ``encoded`` (doc_id, ids): doc_id, ids and the decoded bytes."""

    def make():
        bpe = load_bpe(ranks_path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column("ids")
            decoded = pa.array([bpe.decode(x or []) for x in ids.to_pylist()], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, decoded], names=["doc_id", "ids", "decoded"])

        return step

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id bigint, ids array<int>, decoded binary")


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of their decoding.

    Every row is encoded by itself, so repeated rows, null ids and extra columns need no rule; null
    texts count as empty (no ids, digests of nothing). Encoding and decoding share one pass over
    the text in each task and keep only digests.
    """

    def make():
        cache = digest_parts(ranks_path, pattern)
        cut = segments if never_joins_over_space(pattern) else lambda t: [t]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list] = [[], [], []]
            for group in in_groups(texts_of(batch)):
                parts = [cut(t) if t else [] for t in group]
                known = cache.look_up(parts)
                for p in parts:
                    names, decoded = zip(*map(known.__getitem__, p), strict=True) if p else ((), ())
                    joined = ",".join(names)
                    out[0].append(joined.count(",") + 1 if p else 0)
                    out[1].append(hashlib.sha256(joined.encode()).hexdigest())
                    out[2].append(hashlib.sha256(b"".join(decoded)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, make, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
