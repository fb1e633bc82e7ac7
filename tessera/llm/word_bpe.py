"""Byte-pair encoding of whole words (with word ends) and its decoding.

Pre-tokens become a doubly linked list of symbols; a priority queue holds the merge ranks of adjacent
pairs, and an entry whose pair has changed since is skipped as stale. Decoding concatenates the
vocabulary's strings, with a space between tokens as a tokenizer file without a decoder has it.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections import ChainMap
from collections.abc import Callable, Mapping
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from tessera.llm.common import map_batches, text_or_empty, texts_of

# fixed values: the settings of a tokenizer file that this encoder follows
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


class Memo:
    """Results by text: those met since the last change of generation, and those of the one before.

    A generation ends at ``limit`` entries; results used in it move on, the others go. Texts over
    ``longest`` code points are not kept, so memory is bounded while frequent texts stay.
    """

    def __init__(self, limit: int, longest: int = 48):
        self.limit, self.longest = limit, longest
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def look_up(self, texts: list[str], compute: Callable[[str], tuple[bytes, bytes]]) -> Mapping[str, tuple[bytes, bytes]]:
        """A mapping that holds the result of every text in ``texts``."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        passing = {}
        for text in set(texts).difference(self.young):
            found = self.old.get(text) or compute(text)
            if len(text) <= self.longest:
                self.young[text] = found
            else:
                passing[text] = found
        return ChainMap(passing, self.young) if passing else self.young


class WordBpe:
    """Encoder and decoder of one tokenizer file.

    ``words`` keeps the results of pre-tokens and ``parts`` those of chunks between blanks, both bounded.
    """

    def __init__(self, settings: dict, memo_limit: int = 300_000):
        model, pre = settings["model"], settings["pre_tokenizer"]["pretokenizers"]
        split = pre[0]
        follows = (
            settings["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZERS}
            and split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed"
            and pre[1:] == [_BYTE_LEVEL] and settings["decoder"] is None and settings["post_processor"] is None
            and model["type"] == "BPE" and not model["dropout"] and model["unk_token"] is None
            and not model["continuing_subword_prefix"] and not model["byte_fallback"] and not model["ignore_merges"]
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in settings["added_tokens"]))
        if not follows:
            raise ValueError("the tokenizer file has settings that this encoder does not follow")
        vocab = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.string_of = {n: token for token, n in vocab.items()}
        self.specials = {t["content"]: t["id"] for t in settings["added_tokens"]}
        self.string_of |= {n: token for token, n in self.specials.items()}
        self.first = [vocab[c] for c in byte_letters()]
        self.last = [vocab[c + end] for c in byte_letters()]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank_of = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        # normalizing and splitting go by the library's Unicode tables, which no other module shares exactly
        self._normalize = Tokenizer.from_str(json.dumps(settings)).normalizer.normalize_str
        self._split = Split(Regex(split["pattern"]["Regex"]), "removed", invert=True).pre_tokenize_str
        self._split_ascii = re.compile(
            split["pattern"]["Regex"].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9"), re.ASCII).findall
        longest_first = sorted(self.specials, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.words, self.parts = Memo(memo_limit), Memo(memo_limit)

    def words_of(self, piece: str) -> list[str]:
        """Pre-tokens of a text without special strings: NFC, lower case, split by the file's pattern."""
        if piece.isascii():
            return self._split_ascii(piece.lower())
        return [word for word, _ in self._split(self._normalize(piece))]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the adjacent pair of lowest rank merges first, the left one on ties."""
        symbol = [*map(self.first.__getitem__, word)]
        symbol[-1] = self.last[word[-1]]
        n, rank_of, push, pop = len(symbol), self.rank_of.get, heapq.heappush, heapq.heappop
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        pair = [*map(rank_of, zip(symbol, symbol[1:])), None]  # rank of the pair that starts at a place
        bits = n.bit_length()
        low = (1 << bits) - 1
        queue = [rank << bits | i for i, rank in enumerate(pair) if rank is not None]
        heapq.heapify(queue)
        while queue:
            entry = pop(queue)
            i, rank = entry & low, entry >> bits
            if pair[i] != rank:
                continue  # stale: the pair that starts here has changed since
            j, h, new = after[i], before[i], self.merged[rank]
            k = after[j]
            symbol[i], symbol[j] = new, -1
            after[i] = k
            pair[i] = pair[j] = None
            if k < n:
                before[k] = i
                pair[i] = rank = rank_of((new, symbol[k]))
                if rank is not None:
                    push(queue, rank << bits | i)
            if h >= 0:
                pair[h] = rank = rank_of((symbol[h], new))
                if rank is not None:
                    push(queue, rank << bits | h)
        return [s for s in symbol if s >= 0]

    def _encode_word(self, word: str) -> tuple[bytes, bytes]:
        ids = self.merge(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids).encode()

    def _encode_chunk(self, chunk: str) -> tuple[bytes, bytes]:
        """Ids (32 bit, little endian) and decoding (UTF-8) of a text without blanks."""
        found = []
        for piece in self._special.split(chunk) if self._special else [chunk]:
            if piece in self.specials:
                found.append((struct.pack("<I", self.specials[piece]), piece.encode()))
            elif piece:
                words = self.words_of(piece)
                known = self.words.look_up(words, self._encode_word)
                found += [known[w] for w in words]
        if len(found) == 1:
            return found[0]
        return b"".join([ids for ids, _ in found]), b" ".join([decoded for _, decoded in found])

    def chunks(self, text: str) -> list[str]:
        """Parts of ``text`` between blanks. No pre-token, special string or composed character spans them."""
        for c in "\n\t\r\x0b\x0c":
            text = text.replace(c, " ")
        return text.split(" ")

    def encoded(self, text: str) -> list[tuple[bytes, bytes]]:
        """Per chunk with tokens: its ids and its decoding."""
        chunks = self.chunks(text)
        known = self.parts.look_up(chunks, self._encode_chunk)
        return [p for p in map(known.__getitem__, chunks) if p[0]]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(p[0] for p in self.encoded(text)), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.string_of.__getitem__, ids))


@lru_cache(maxsize=2)
def load_word_bpe(path: str) -> WordBpe:
    """The encoder of a file, one per worker process: its memo outlives a task."""
    with open(path, encoding="utf-8") as f:
        return WordBpe(json.load(f))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def encode_words(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array of int) of the whole text. Null texts count as empty (no ids)."""

    def make():
        bpe = load_word_bpe(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data = [b"".join(p[0] for p in bpe.encoded(t)) for t in texts_of(batch)]
            ends = np.cumsum([0, *(len(d) // 4 for d in data)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4")))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

        return step

    return map_batches(_rows(docs), make, "doc_id bigint, ids array<int>")


def decode_words(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of ``encoded`` (doc_id, ids): doc_id and the decoded text; null ids count as none."""

    def make():
        bpe = load_word_bpe(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            decoded = pa.array([bpe.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), decoded], names=["doc_id", "decoded"])

        return step

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id bigint, decoded string")


def word_bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of their decoding.

    Each row is encoded by itself, so repeated rows, null ids and extra columns need no rule; null and
    empty texts have no tokens (digests of nothing), and no rows give no rows. Special strings in a text
    are their special tokens. A task holds one batch of texts and the bounded memo; long texts are
    cut at blanks, so only a pre-token without any is merged as one list.
    """

    def make():
        bpe = load_word_bpe(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, ids_sha, decoded_sha = [], [], []
            for text in texts_of(batch):
                found = list(chain.from_iterable(bpe.encoded(text)))
                ids = b"".join(found[::2])
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                decoded_sha.append(hashlib.sha256(b" ".join(found[1::2])).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    return map_batches(_rows(docs), make, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
