"""Integer components of embedding vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest absolute component: keeps squared distances of up to 64 dimensions within 64 bits.
LARGEST = 1 << 27


def whole_components(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, computed in double; raises where it passes ``LARGEST``."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) <= LARGEST, F.floor(y)).otherwise(
            F.raise_error(F.lit(f"a component passes {LARGEST} after scaling")).cast("bigint"))

    return F.transform(vector, whole)


def finite(vector: Column) -> Column:
    """Whether no component is null, NaN or infinite."""
    return ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
