"""Records of CSV files whose quoted fields may hold newlines, read in splits.

A newline ends a record only outside quotes, and a task that starts in the middle of a file cannot see on
which side it is. Two passes prove it:

1. *Parity*: per split, whether its lines hold an odd number of quotes (an aggregate over plain lines, one
   row per split). Running these along a file tells for every split whether it starts inside quotes.
2. *Records*: each task starts from its proven state and joins the lines of a record. The pieces of a record
   that lies across split edges are left out there; if there are such records, one more pass picks their
   pieces (a few per split) and joins them by record.

The proof needs quotes to stand only around whole fields and doubled inside them. A record with any other quote
raises, as does a file that ends inside quotes or separates its records by lone carriage returns.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE = '"'
BOM = "\ufeff"
#: Stands for a quoted part while a record is tested; the reader's null marker, so never in the data.
MARK = "\u0001"


@dataclass
class SplitPlan:
    """What the parity pass proved; at most one entry per split, as the scan's own plan has.

    ``crossing``: split that starts inside quotes -> (split in which that record starts, its turn in the record).
    ``skip``: split -> lines left out at its start. ``first``: the files' first splits. ``crlf``: splits of files whose
    lines end in CR LF. ``splits``: all of them; a scan that is cut otherwise (after a change of the session's split
    size, or of a file) is refused.
    """

    crossing: dict[int, tuple[int, int]] = field(default_factory=dict)
    skip: dict[int, int] = field(default_factory=dict)
    first: set[int] = field(default_factory=set)
    crlf: set[int] = field(default_factory=set)
    splits: set[int] = field(default_factory=set)


def _lines(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Lines with the split they start in, in file order within a split."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", "_metadata.file_path", "_metadata.file_block_start",
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("split"))


def _place(path: str) -> str:
    """A path without its scheme, which listings and scans write differently (``file:/``, ``file:///``)."""
    return re.sub(r"^[a-z0-9+.-]+:/*", "/", path)


def leading_lines(spark: SparkSession, path: str, n_records: int) -> int:
    """How many lines the first ``n_records`` records of a file take, blank lines before them included."""
    looked_at = 4 * n_records + 4
    while True:
        lines = [r.value for r in spark.read.option("lineSep", "\n").text(path).limit(looked_at).collect()]
        inside, records = False, 0
        for number, line in enumerate(lines, 1):
            blank = not inside and line.removeprefix(BOM if number == 1 else "") in ("", "\r")
            inside ^= line.count(QUOTE) % 2 == 1
            records += not inside and not blank
            if records == n_records:
                return number
        if len(lines) < looked_at:
            return len(lines)
        looked_at *= 4


def plan_splits(spark: SparkSession, paths: list[str], skip_lines: dict[str, int] | None = None) -> SplitPlan:
    """The parity pass over the files; ``skip_lines``: path -> lines to leave out at its start."""
    value = F.col("value")
    odd = (F.octet_length(value) - F.octet_length(F.replace(value, F.lit(QUOTE), F.lit("")))) % 2
    return_at = F.when(F.col("file_block_start") == 0, F.instr(value, "\r"))
    splits = _lines(spark, paths).withColumn("line", F.monotonically_increasing_id()).groupBy(
        "file_path", "file_block_start", "split").agg(
        F.max(odd).alias("changes"), F.bit_xor(odd).alias("odd"), F.count(F.lit(1)).alias("n_lines"),
        F.min_by(F.struct(return_at.alias("at"), F.char_length(value).alias("length")), "line").alias("first_return"),
    ).collect()
    plan = SplitPlan(splits={s.split for s in splits})
    if len(plan.splits) != len(splits):
        raise RuntimeError("two splits share an identifier")
    to_skip = {_place(p): n for p, n in (skip_lines or {}).items()}
    splits.sort(key=lambda s: (s.file_path, s.file_block_start))
    for path, of_file in groupby(splits, key=lambda s: s.file_path):
        inside, record, turn, crlf = False, 0, 0, False
        left = to_skip.pop(_place(unquote(path)), 0)
        for number, s in enumerate(of_file):
            if number == 0:
                plan.first.add(s.split)
                crlf = bool(s.first_return["at"]) and s.first_return["at"] == s.first_return["length"]
                if s.first_return["at"] and not crlf:
                    raise ValueError(f"{path} has a lone carriage return in its first line")
            if crlf:
                plan.crlf.add(s.split)
            if left:
                plan.skip[s.split] = min(left, s.n_lines)
                left -= plan.skip[s.split]
            if inside:
                turn += 1
                plan.crossing[s.split] = (record, turn)
            inside ^= bool(s.odd)
            if inside and s.changes:
                record, turn = s.split, 0
        if inside:
            raise ValueError(f"{path} ends inside quotes")
    if any(to_skip.values()):
        raise RuntimeError(f"no lines found in {sorted(to_skip)}")
    return plan


class _Assembler:
    """Joins the lines of one split into records and pieces of records that cross its edges."""

    def __init__(self, split: int, plan: SplitPlan):
        if split not in plan.splits:
            raise RuntimeError("files are not cut into the splits that were planned; read them again")
        self.split, self.skip, self.strip_return = split, plan.skip.get(split, 0), split in plan.crlf
        self.piece = plan.crossing.get(split)  # the record under way began in an earlier split
        self.inside = self.piece is not None
        self.at_file_start = split in plan.first
        self.held: list[pa.Array] = []

    def add(self, lines: pa.Array) -> tuple[pa.Array, list[tuple[int, int, str]]]:
        """Records that end in ``lines``, and the piece that ends a record of an earlier split."""
        if self.at_file_start and len(lines):
            self.at_file_start = False
            if (line := lines[0].as_py()).startswith(BOM):
                lines = pa.concat_arrays([pa.array([line[len(BOM):]], lines.type), lines[1:]])
        if self.skip:
            skipped = min(self.skip, len(lines))
            lines, self.skip = lines[skipped:], self.skip - skipped
            self.inside, self.piece = False, None  # whole records are skipped
        if not len(lines):
            return lines, []
        odd = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False) & 1
        inside = np.cumsum(odd) + self.inside & 1
        ends = np.flatnonzero(inside == 0) + 1
        if not len(ends):
            self.held.append(lines)
            self.inside = True
            return lines[:0], []
        n_held = sum(map(len, self.held))
        used = pa.concat_arrays([*self.held, lines[:ends[-1]]])
        self.inside = bool(inside[-1])
        self.held = [lines[ends[-1]:]] if self.inside else []
        if len(ends) == len(used):
            records = used  # each line is a record
        else:
            offsets = pa.array(np.concatenate([[0], ends + n_held]), pa.int32())
            records = pc.binary_join(pa.ListArray.from_arrays(offsets, used), "\n")
        if self.strip_return:
            # as the reader of whole files does, inside quotes too
            records = pc.replace_substring(pc.replace_substring_regex(records, r"\r\z", ""), "\r\n", "\n")
        if self.piece is None:
            return records, []
        (record, turn), self.piece = self.piece, None
        return records[1:], [(record, turn, records[0].as_py())]

    def rest(self) -> list[tuple[int, int, str]]:
        """The piece of a record that goes on in the next split."""
        if not self.held:
            return []
        text = "\n".join(line for lines in self.held for line in lines.to_pylist())
        if self.strip_return:
            text = text.replace("\r\n", "\n").removesuffix("\r")
        return [(*(self.piece or (self.split, 0)), text)]


def _assembled(batches: Iterator[pa.RecordBatch], plan: SplitPlan) -> Iterator[tuple[pa.Array | None, list[tuple[int, int, str]]]]:
    now: _Assembler | None = None
    for batch in batches:
        ids = batch.column("split").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for start, stop in zip(cuts, cuts[1:]):
            if start == stop:
                continue
            if now is None or now.split != ids[start]:
                if now is not None:
                    yield None, now.rest()
                now = _Assembler(int(ids[start]), plan)
            yield now.add(batch.column("value").slice(start, stop - start))
    if now is not None:
        yield None, now.rest()


def split_records(spark: SparkSession, paths: list[str], plan: SplitPlan) -> DataFrame:
    """One column ``record``: every record of the files as text, blank ones left out."""
    lines = _lines(spark, paths).select("value", "split")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for records, _ in _assembled(batches, plan):
            if records is not None and len(records):
                yield pa.RecordBatch.from_arrays([records], names=["record"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _assembled(batches, plan):
            if found:
                yield pa.RecordBatch.from_pylist([{"started": s, "turn": n, "text": t} for s, n, t in found], pa.schema(
                    [("started", pa.int64()), ("turn", pa.int32()), ("text", pa.string())]))

    records = lines.mapInArrow(whole, "record string")
    if plan.crossing:
        in_turn = F.array_sort(F.collect_list(F.struct("turn", "text")))
        joined = lines.mapInArrow(pieces, "started bigint, turn int, text string").groupBy("started").agg(
            F.array_join(F.transform(in_turn, lambda x: x["text"]), "\n").alias("record"))
        records = records.union(joined.select("record"))
    return records.where(F.col("record") != "")


def with_proven_quotes(record: Column) -> Column:
    """``record``, raising (when read) where a quote is neither around a whole field nor doubled in one."""
    marked = F.regexp_replace(record, '"[^"]*"', MARK)
    wrong = marked.contains(QUOTE) | marked.rlike(f"[^,{MARK}]{MARK}|{MARK}[^,{MARK}]")
    return F.when(record.contains(QUOTE) & wrong, F.raise_error(F.concat(
        F.lit("a quote inside an unquoted field; read with split=False: "), F.substring(record, 1, 200)))).otherwise(record)


# Ship this module's code with the tasks by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
