"""Deterministic reducing aggregates.

Each returns an aggregate ``Column`` for ``groupBy(...).agg(...)``, so any number
of them share one scan, one partial (map-side) aggregation and one shuffle on the
grouping keys. Buffers hold one entry per *distinct value* in a group, never the
group's rows, so a hot group that holds a third of the data still partially
aggregates on every map task and merges a handful of small buffers.

Tie rules are fixed so results are repeatable on any partitioning:

* ``modal_value``: most frequent non-null value; ties -> lowest value.
* ``modal_tuple``: most frequent combination (nulls count as values); ties ->
  each member ascending, nulls last, in the order given.
* ``first_non_null``: with an order column, the value at the lowest order;
  without one, the lowest value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_non_null(value: Column | str, order: Column | str | None = None) -> Column:
    """A representative non-null value per group; null if every value is null."""
    v = _c(value)
    if order is None:
        return F.min(v)
    return F.min_by(v, F.when(v.isNotNull(), _c(order)))


def modal_value(value: Column | str) -> Column:
    """Most frequent non-null value (ties -> lowest); null when all are null."""
    return F.mode(_c(value), deterministic=True)


# Order-preserving text key for one integral member: a null flag ("0" present,
# "1" null, so nulls sort last) then the value as fixed-width upper-case hex with
# its sign bit flipped, so text order equals numeric order. 64-bit members take
# 16 digits; members known to fit 32 bits take 8 (a shorter key is cheaper to
# build, copy and hash for every row).
_SIGN64 = -(2 ** 63)
_OFFSET32 = 2 ** 31


def _member_key(c: Column, bits: int = 64) -> Column:
    if bits == 32:
        digits = F.lpad(F.hex(c.cast("bigint") + F.lit(_OFFSET32)), 8, "0")
        null_key = "1" + "0" * 8
    else:
        digits = F.lpad(F.hex(c.cast("bigint").bitwiseXOR(F.lit(_SIGN64))), 16, "0")
        null_key = "1" + "0" * 16
    return F.when(c.isNull(), F.lit(null_key)).otherwise(F.concat(F.lit("0"), digits))


def _member_value(key: Column, i: int, bits: int = 64) -> Column:
    width = 1 + bits // 4
    start = i * width + 1
    digits = F.substring(key, start + 1, bits // 4)
    if bits == 32:
        value = F.conv(digits, 16, 10).cast("bigint") - F.lit(_OFFSET32)
    else:
        value = F.conv(digits, 16, -10).cast("bigint").bitwiseXOR(F.lit(_SIGN64))
    return F.when(F.substring(key, start, 1) == F.lit("0"), value)


def modal_tuple(*cols: str, bits: int = 64) -> Column:
    """Most frequent combination of integral ``cols`` taken together (a struct of bigints).

    The combination is counted as a whole, so the members always come from the
    same observations (a start never pairs with another submission's end). Nulls
    are ordinary values here. Ties break on each member ascending, nulls last.
    Pass ``bits=32`` when every member fits 32 bits (int, smallint, tinyint).

    The combination is folded into one order-preserving text key and reduced
    with the scalar ``mode``: a struct-typed ``mode`` key is not safe once the
    object hash aggregate falls back to sort-based merging (deserialized and
    in-memory struct keys stop comparing equal), text keys are compared by
    content on every path.
    """
    if bits not in (32, 64):
        raise ValueError("bits must be 32 or 64")
    keys = [_member_key(F.col(c), bits) for c in cols]
    modal = F.mode(F.concat(*keys) if len(keys) > 1 else keys[0], deterministic=True)
    return F.struct(*[_member_value(modal, i, bits).alias(c) for i, c in enumerate(cols)])


def member_bits(df_dtypes: dict, cols) -> int:
    """32 when every column is an integer type of at most 32 bits, else 64."""
    return 32 if all(df_dtypes.get(c) in ("int", "smallint", "tinyint") for c in cols) else 64


def tuple_member(modal: Column | str, name: str) -> Column:
    """One member of a :func:`modal_tuple` result."""
    return _c(modal).getField(name)


def distinct_sorted_list(value: Column | str) -> Column:
    """Distinct non-null values, ascending; ``[]`` when all are null."""
    return F.array_sort(F.collect_set(_c(value)))


def distinct_count_with_nulls(value: Column | str) -> Column:
    """Number of distinct values, counting null as one value of its own."""
    v = _c(value)
    return F.count_distinct(v) + F.coalesce(F.max(v.isNull().cast("int")), F.lit(0))


def row_count() -> Column:
    """Rows in the group, nulls included."""
    return F.count(F.lit(1))
