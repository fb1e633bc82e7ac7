"""Damerau-Levenshtein distance (unrestricted form) as an Arrow-batched pandas UDF.

Spark has no Damerau-Levenshtein builtin. The search operators only call this
kernel on pairs that already passed the JVM-side prefilters (length difference
and ``levenshtein(a, b, 2k)``), so the Python path sees survivors only.

The unrestricted form lets a transposed pair be edited again, so
``("CA", "ABC") -> 2`` where the restricted (optimal string alignment) form gives 3.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def dl_distance(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance of one pair (Lowrance-Wagner recurrence)."""
    if a == b:
        return 0
    la, lb = len(a), len(b)
    if la == 0:
        return lb
    if lb == 0:
        return la
    big = la + lb
    # table with one sentinel row/column in front: d[i + 1][j + 1] is the distance
    # between the first i characters of a and the first j characters of b
    d = [[big] * (lb + 2) for _ in range(la + 2)]
    for i in range(la + 1):
        d[i + 1][1] = i
    for j in range(lb + 1):
        d[1][j + 1] = j
    last_row: dict[str, int] = {}
    for i in range(1, la + 1):
        ai = a[i - 1]
        last_match_col = 0
        for j in range(1, lb + 1):
            bj = b[j - 1]
            k = last_row.get(bj, 0)
            l = last_match_col
            if ai == bj:
                cost = 0
                last_match_col = j
            else:
                cost = 1
            d[i + 1][j + 1] = min(
                d[i][j] + cost,
                d[i + 1][j] + 1,
                d[i][j + 1] + 1,
                d[k][l] + (i - k - 1) + 1 + (j - l - 1),
            )
        last_row[ai] = i
    return d[la + 1][lb + 1]


def dl_within(a: list[str], b: list[str], k: int) -> np.ndarray:
    """Distances of the pairs ``(a[n], b[n])``, with ``k + 1`` for every distance above ``k``.

    All pairs advance together, row by row, over the ``2k + 1`` diagonals a distance of
    ``k`` can reach; a pair leaves when its whole band exceeds ``k``. A transposition with
    ``p`` and ``q`` edits between its ends costs ``p + q + 1``, so ``p + q < k``.
    """
    n = len(a)
    over = k + 1
    result = np.full(n, over, dtype=np.int32)
    la = np.fromiter(map(len, a), np.int32, n)
    lb = np.fromiter(map(len, b), np.int32, n)
    todo = np.flatnonzero(np.abs(la - lb) <= k)
    if not len(todo):
        return result
    la, lb = la[todo], lb[todo]

    def codes(texts: list[str], lengths: np.ndarray, pad: int) -> np.ndarray:
        # texts start at column `margin`; what lies outside equals nothing
        out = np.full((len(todo), int(lengths.max(initial=0)) + 2 * margin), pad, dtype=np.int32)
        for row, at in enumerate(todo):
            out[row, margin:margin + lengths[row]] = np.frombuffer(texts[at].encode("utf-32-le"), dtype=np.int32)
        return out

    margin = 2 * k + 3
    ca, cb = codes(a, la, -1), codes(b, lb, -2)
    band = 2 * k + 1
    shift = np.arange(-k, k + 1)
    # rows[-1] is the last one; a row holds d[i, i - k .. i + k] for every pair
    first = np.where(shift >= 0, shift, over).astype(np.int32)
    rows = [np.full((len(todo), band), over, dtype=np.int32) for _ in range(k + 1)] + [np.tile(first, (len(todo), 1))]
    for i in range(int(la.max(initial=0)) + 1):
        done = np.flatnonzero(la == i)
        if len(done):
            result[todo[done]] = np.minimum(rows[-1][done, lb[done] - i + k], over)
        stay = np.flatnonzero((la > i) & (rows[-1].min(axis=1) <= k))
        if len(stay) < len(todo):
            todo, la, lb, ca, cb = todo[stay], la[stay], lb[stay], ca[stay], cb[stay]
            rows = [r[stay] for r in rows]
        if not len(todo):
            break
        new = np.full((len(todo), band), over, dtype=np.int32)
        x = ca[:, margin + i]
        for o in range(band):
            j = i + 1 + o - k  # d[i + 1, j] ends with b[j - 1]
            if j < 0 or j > int(lb.max(initial=0)):
                continue
            if j == 0:
                new[:, o] = min(i + 1, over)
                continue
            y = cb[:, margin + j - 1]
            best = rows[-1][:, o] + (x != y)
            if o:
                best = np.minimum(best, new[:, o - 1] + 1)
            if o + 1 < band:
                best = np.minimum(best, rows[-1][:, o + 1] + 1)
            for p in range(k):
                for q in range(k - p):
                    # from d[i - 1 - p, j - 2 - q]; the same diagonal but for p - q
                    back = o + p - q
                    if i - 1 - p < 0 or j - 2 - q < 0 or not 0 <= back < band:
                        continue
                    swap = (x == cb[:, margin + j - 2 - q]) & (y == ca[:, margin + i - 1 - p])
                    best = np.where(swap, np.minimum(best, rows[-2 - p][:, back] + p + q + 1), best)
            new[:, o] = np.minimum(best, over)
        rows = rows[1:] + [new]
    return result


#: Cells of all tables that are filled together, and the fewest pairs for which that pays.
TABLE_CELLS, FEWEST_TOGETHER = 4_000_000, 16


def _codes(texts: list[str], longest: int, pad: int, letters: dict[str, int]) -> np.ndarray:
    """Texts as rows of letter numbers, ``pad`` behind their ends; new letters are added to ``letters``."""
    out = np.full((len(texts), longest), pad, dtype=np.int32)
    for row, text in enumerate(texts):
        out[row, :len(text)] = [letters.setdefault(c, len(letters)) for c in text]
    return out


def _filled_together(a: list[str], b: list[str]) -> np.ndarray:
    """Distances of the pairs ``(a[n], b[n])``: the recurrence of :func:`dl_distance`, one cell of every table at a time."""
    n = len(a)
    la, lb = np.fromiter(map(len, a), np.int32, n), np.fromiter(map(len, b), np.int32, n)
    letters: dict[str, int] = {}
    long_a, long_b = int(la.max()), int(lb.max())
    ca, cb = _codes(a, long_a, -2, letters), _codes(b, long_b, -1, letters)  # pads are the last two letters
    pairs = np.arange(n)
    d = np.empty((long_a + 2, long_b + 2, n), dtype=np.int32)
    d[0], d[:, 0] = long_a + long_b, long_a + long_b
    d[1:, 1] = np.arange(long_a + 1)[:, None]
    d[1, 1:] = np.arange(long_b + 1)[:, None]
    last_row = np.zeros((n, len(letters) + 2), dtype=np.int32)
    for i in range(1, long_a + 1):
        x = ca[:, i - 1]
        last_col = np.zeros(n, dtype=np.int32)
        for j in range(1, long_b + 1):
            y = cb[:, j - 1]
            k, l, same = last_row[pairs, y], last_col, x == y
            swapped = d[k, l, pairs] + (i - k) + (j - l - 1)
            best = np.minimum(d[i, j] + ~same, np.minimum(d[i + 1, j], d[i, j + 1]) + 1)
            d[i + 1, j + 1] = np.minimum(best, swapped)
            last_col = np.where(same, j, last_col).astype(np.int32)
        last_row[pairs, x] = i
    return d[la + 1, lb + 1, pairs]


def dl_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Distances of the pairs ``(a[n], b[n])``; a pair that repeats is computed once.

    Pairs of like lengths fill their tables together, in groups of bounded memory; where few are left, as for
    very long texts, each goes by itself.
    """
    distinct = sorted(set(zip(a, b)), key=lambda p: (len(p[0]), len(p[1])))
    found: dict[tuple[str, str], int] = {}
    start = 0
    while start < len(distinct):
        cells, stop, long_b = 0, start, 0
        while stop < len(distinct):
            long_b = max(long_b, len(distinct[stop][1]))
            cells = (len(distinct[stop][0]) + 2) * (long_b + 2) * (stop + 1 - start)
            if cells > TABLE_CELLS and stop > start:
                break
            stop += 1
        group = distinct[start:stop]
        if len(group) < FEWEST_TOGETHER:
            found.update((p, dl_distance(*p)) for p in group)
        else:
            found.update(zip(group, _filled_together([p[0] for p in group], [p[1] for p in group]).tolist()))
        start = stop
    return np.fromiter(map(found.__getitem__, zip(a, b)), np.int32, len(a))


def _dl_series(a: pd.Series, b: pd.Series) -> pd.Series:
    known = (a.notna() & b.notna()).to_numpy()
    out = np.zeros(len(a), dtype=np.int32)
    out[known] = dl_distances(a[known].tolist(), b[known].tolist())
    return pd.Series(out, dtype="Int32").mask(~known)


# Marked non-deterministic so the optimizer never duplicates the Python call:
# a filter on the distance would otherwise be pushed below a de-duplicating
# aggregate and the kernel evaluated a second time for the projection.
_dl_udf = F.pandas_udf(_dl_series, IntegerType()).asNondeterministic()


def damerau_levenshtein_within(a: Column | str, b: Column | str, k: int) -> Column:
    """Distance column, null above ``k`` and when either side is null. Prefilter first."""

    def kernel(x: pd.Series, y: pd.Series) -> pd.Series:
        known = (x.notna() & y.notna()).to_numpy()
        out = np.full(len(x), k + 1, dtype=np.int32)
        out[known] = dl_within(x[known].tolist(), y[known].tolist(), k)
        return pd.Series(out, dtype="Int32").mask(out > k)

    udf = F.pandas_udf(kernel, IntegerType()).asNondeterministic()
    return udf(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def damerau_levenshtein(a: Column | str, b: Column | str) -> Column:
    """Distance column (null when either side is null). Python path: prefilter first."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return _dl_udf(ca, cb)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``damerau_levenshtein(a, b)`` callable in the session's SQL (null when either side is null)."""
    spark.udf.register("damerau_levenshtein", F.pandas_udf(_dl_series, IntegerType()))


def within_prefilter(a: Column | str, b: Column | str, k: int) -> Column:
    """JVM-side necessary condition for ``DL(a, b) <= k``.

    A transposition costs 1 in DL and at most 2 in Levenshtein, so DL <= k implies
    Levenshtein <= 2k; Spark's thresholded ``levenshtein`` returns -1 above it and
    stops early. The length test is cheaper still and goes first.
    """
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return (F.abs(F.char_length(ca) - F.char_length(cb)) <= k) & (F.levenshtein(ca, cb, 2 * k) >= 0)


# Ship this module's code with the UDF by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
