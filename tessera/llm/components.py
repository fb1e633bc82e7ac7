"""Connected components of a graph whose edges do not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) for every end of an edge; ``component`` is the smallest id reachable.

    Alternates large-star and small-star steps, which halve distances: every id links its larger
    neighbours to its smallest one, then its smaller ones. Each step aggregates minima before the
    shuffle and joins them back, so an id with very many neighbours stays a sum and a split join.
    Every round is a written table. No edges give an empty result.
    """
    edges = written(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct(), "edges")
    state = _signature(edges)
    while True:
        # large star: of both directions, the minimum around v goes to the neighbours above v
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # small star: the minimum below v goes to the neighbours below v, and to v
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v != u").union(
            least.select("v", F.col("m").alias("u"))).distinct()
        edges = written(small, "edges")
        now = _signature(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("v").alias("id"), F.col("u").alias("component")).union(
        edges.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct())
