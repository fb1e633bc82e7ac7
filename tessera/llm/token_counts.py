"""Token counts by a sentencepiece model, huge documents in overlapping chunks."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import map_batches, text_or_empty, texts_of
from tessera.llm.segments import SegmentCache, in_groups, segments

SPACE = "▁"
TOKEN_LIMIT = 4096
#: Documents of more code points are encoded in chunks of CHUNK with OVERLAP in common.
HUGE = 16_384
CHUNK = 8_192
OVERLAP = 256


@lru_cache(maxsize=4)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def never_joins_over_space(path: str) -> bool:
    """Whether no token of the model holds a space after another character, nothing rewrites the
    text, and spaces stand before words: then a cut before such a space is a token boundary in
    every text, whatever surrounds it."""
    sp = processor(path)
    inner = re.compile(f"[^{SPACE}]{SPACE}")
    if any(inner.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size())):
        return False
    probe = " ａ  é\t  b "
    return sp.encode(probe) != sp.encode(probe.strip()) and sp.decode(sp.encode(probe)) == probe


def boundaries(sp, text: str) -> list[tuple[int, int]]:
    """(offset, tokens before it) for every token boundary of ``text`` that is a whole code point."""
    at, out, pending = 0, [], b""
    pieces = sp.encode(text, out_type=str)
    for k, piece in enumerate(pieces):
        if not pending:
            out.append((at, k))
        if len(piece) == 6 and piece.startswith("<0x") and not text.startswith(piece, at):
            pending += bytes([int(piece[3:5], 16)])
            try:
                at += len(pending.decode())
                pending = b""
            except UnicodeDecodeError:
                pass
        else:
            # the space that the model puts before a text is no character of it
            at += len(piece) - (k == 0)
    out.append((len(text), len(pieces)))
    return out


def stable(text: str, at: int) -> bool:
    """A space follows another character here: no token can span it."""
    return 0 < at < len(text) and text[at] == " " and text[at - 1] not in (" ", SPACE)


def count_in_chunks(sp, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, encoding overlapping chunks and splicing them where both agree.

    Two neighbouring chunks share ``overlap`` code points. They are spliced at the last offset
    in the shared part that is a token boundary of both and lies where no token can span. Where
    there is none, the overlap is doubled, up to the whole rest of the document.
    """
    total, start, width = 0, 0, chunk
    while True:
        end = min(len(text), start + width)
        marks = boundaries(sp, text[start:end])
        if end == len(text):
            return total + marks[-1][1]
        shared = overlap
        while True:
            # the next chunk begins inside this one
            begin = max(start + 1, end - shared)
            ahead = {begin + at for at, _ in boundaries(sp, text[begin:min(len(text), begin + 2 * shared)])}
            cut = next(((at, n) for at, n in reversed(marks)
                        if begin < start + at < end and start + at in ahead and stable(text, start + at)), None)
            if cut:
                break
            if begin == start + 1:
                break
            shared *= 2
        if cut is None:
            # no common stable boundary in the whole chunk: a longer one
            width *= 2
            continue
        # the space at the cut is put before the next chunk by the model itself
        total, start, width = total + cut[1], start + cut[0] + 1, chunk


def token_counts(docs: DataFrame, model_path: str, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP,
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``.

    Counts are those of the library for the whole text, without begin or end tokens; strings of
    special tokens are ordinary text, as is the library's default. Null texts count as empty (no
    tokens). Each row is counted by itself, so repeated rows, null ids and extra columns need no
    rule. Documents of more than ``huge`` code points are encoded in overlapping chunks; others in
    segments cut at the same stable boundaries, whose counts a bounded cache keeps. If the model's
    tokens can span spaces, whole texts are encoded.
    """

    def make():
        sp = processor(model_path)
        by_segment = never_joins_over_space(model_path)
        # inside a text a segment starts with the space that the model would put before it
        inner = SegmentCache(
            lambda found: [max(1, len(x)) for x in sp.encode([s[1:] for s in found], num_threads=1)])

        def count(texts: list[str]) -> list[int]:
            if not by_segment:
                return [len(sp.encode(t)) for t in texts]
            parts = [segments(" " + t) if 0 < len(t) <= huge else [] for t in texts]
            tokens = inner.look_up(parts)
            return [sum(map(tokens.__getitem__, p)) if len(t) <= huge else count_in_chunks(sp, t, chunk, overlap)
                    for t, p in zip(texts, parts, strict=True)]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch)
            n = [x for group in in_groups(texts) for x in count(group)]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

        return step

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    return map_batches(rows, make, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
