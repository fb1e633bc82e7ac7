"""Exact deduplication that stays even when one text holds a large share of all rows.

Three levels, each comparing whole normalised contents and not only digests:
copies meet first inside a partition (map-side combine), then in one of
``salts`` groups per content, then the at most ``salts`` winners of a content
meet. Every level keeps one winner and a count, so no task ever holds a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty, without_white_space, written

_ID_SPAN = 1 << 65
_ID_TOP = 1 << 63
#: Texts with more than 1 / HOT_PARTS of all rows are spread over the salts when rows are
#: labelled; there are fewer than HOT_PARTS such texts, which bounds the broadcast.
HOT_PARTS = 1024


def text_digest(norm: Column) -> Column:
    return F.sha2(norm, 256)


def _big(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    """One decimal that orders by length, then by smaller id (null ids last); fits a hash aggregate."""
    inverse_id = F.coalesce(_big(_ID_TOP) - doc_id.cast("decimal(20,0)"), F.lit(0).cast("decimal(21,0)"))
    return (n_chars.cast("decimal(10,0)") * _big(_ID_SPAN) + inverse_id).cast("decimal(32,0)")


def _id_of(rank: Column) -> Column:
    inverse_id = rank % _big(_ID_SPAN)
    return F.when(inverse_id != 0, (_big(_ID_TOP) - inverse_id).cast("long"))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 32,
    digest: Callable[[Column], Column] = text_digest,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when identical after deleting the white space
    ``[\\x20\\x09-\\x0D]``. The row with the most code points in its original text
    stays, then the one with the smallest id. Null texts count as empty and form
    one group with other empty texts; a null id loses against any other id. Of
    repeated rows (same id and text) exactly one stays. Extra columns of ``docs``
    are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).select(
        "doc_id", F.char_length("text").alias("n_chars"), without_white_space(F.col("text")).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm")))

    local = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = local.groupBy("salt", "digest", "norm").agg(
        F.max(_rank(F.col("n_chars"), F.col("doc_id"))).alias("rank"), F.count(F.lit(1)).alias("n"))
    merged = salted.groupBy("digest", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"))
    winners = written(
        merged.select("digest", F.xxhash64("norm").alias("norm_hash"), _id_of(F.col("rank")).alias("keep_id"),
                      F.floor(F.col("rank") / _big(_ID_SPAN)).cast("int").alias("keep_chars"), "group_size"),
        "dedup-winners")

    keys = ["digest"]
    if winners.groupBy("digest").count().where("count > 1").limit(1).count():
        # contents that share a digest: tell them apart by a second hash of the content
        keys = ["digest", "norm_hash"]
        rows = rows.withColumn("norm_hash", F.xxhash64("norm"))
    total = winners.agg(F.sum("group_size")).first()[0] or 0
    hot = winners.where(F.col("group_size") > total / HOT_PARTS).select(*keys)
    rows = rows.drop("norm").join(F.broadcast(hot.withColumn("is_hot", F.lit(True))), keys, "left").withColumn(
        "salt", F.when(F.col("is_hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(F.lit(0))).drop("is_hot")
    spread = F.when(F.col("group_size") > total / HOT_PARTS, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0)))
    labelled = rows.join(winners.withColumn("salt", F.explode(spread.cast("array<bigint>"))), [*keys, "salt"])
    repeat = F.row_number().over(W.partitionBy(*keys, "salt", "doc_id").orderBy(F.col("n_chars").desc()))
    return labelled.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars")) & (repeat == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"), "n_chars")


def drop_exact_copies(docs: DataFrame, salts: int = 32) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they came."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keys = ["__key", "__digest", "__chars"]
    stays = exact_dedup(docs, salts=salts).where("kept").select(
        key.alias("__key"), F.col("text_sha256").alias("__digest"), F.col("n_chars").alias("__chars"))
    rows = docs.select(
        key.alias("__key"), text_digest(without_white_space(text_or_empty())).alias("__digest"),
        F.char_length(text_or_empty()).alias("__chars"), F.struct("*").alias("__row"))
    # rows repeated with their id meet once more; the join has dealt them by the same keys
    return rows.join(stays, keys, "left_semi").dropDuplicates(keys).select("__row.*")
