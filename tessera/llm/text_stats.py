"""Statistics of whole texts as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.llm.common import WHITE_SPACE

_WS = r"[\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space, as an array."""
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WS + "+"))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE_SPACE)) != "")


def n_equal_earlier(items: Column) -> Column:
    """How many items equal an earlier one."""
    return (F.size(items) - F.size(F.array_distinct(items))).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")


def n_repeat_words(word_array: Column, width: int = 8) -> Column:
    """Words covered by windows of ``width`` words that occur twice or more, their first place included.

    Windows are compared by 64-bit hashes of word hashes. Texts without an equal pair of windows,
    nearly all, need one pass; in others the sorted (hash, place) pairs give the places, and each
    place covers words up to the next one or its whole width.
    """

    def window_hashes(hashes: Column) -> Column:
        return F.when(F.size(hashes) < width, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])))

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - p, F.lit(width)))),
            F.lit(0), lambda total, n: total + n)

    def places(pairs: Column) -> Column:
        def seen_twice(pair: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(pairs, i - 1)["h"] == pair["h"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["h"] == pair["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(pairs, seen_twice), lambda pair: pair["p"]))

    def repeated(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(let(pairs, places), covered))

    hashes = F.transform(word_array, lambda w: F.xxhash64(w))
    return let(let(hashes, window_hashes), repeated).cast("long")
