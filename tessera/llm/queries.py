"""Registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import bpe_round_trip
from tessera.llm.centroid_clusters import cluster_vectors
from tessera.llm.common import read_table
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.hard_negatives import mine_hard_negatives
from tessera.llm.jaccard_join import similar_documents
from tessera.llm.license_scan import scan_licenses
from tessera.llm.packing import pack_documents
from tessera.llm.pii import find_personal_data
from tessera.llm.quality_classifier import classify_quality
from tessera.llm.quality_rules import quality_rules
from tessera.llm.sharding import shard_documents
from tessera.llm.token_counts import token_counts
from tessera.llm.word_bpe import word_bpe_round_trip


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents"), n=3, percent=90)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(read_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(read_table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe_round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_quality_rules": op4_quality_rules,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_license_scan": op8_license_scan,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_pii": op10_pii,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_word_bpe": op13_word_bpe,
}

def _round_sql(n: int) -> str:
    """One round of clustering: ``c{n}`` (k, v) -> ``c{n + 1}``; empty clusters keep their centroid."""
    return f"""
a{n} AS (SELECT vec_id, v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
           SELECT e.vec_id, e.v, c.k, list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.v[i]) * (e.v[i] - c.v[i])))::bigint AS d
           FROM kept e, c{n} c) GROUP BY vec_id, v),
m{n} AS (SELECT k, list(x ORDER BY i) AS v FROM (
           SELECT k, i, floor(sum(v[i])::double / count(*))::bigint AS x FROM a{n}, range(1, 65) r(i) GROUP BY k, i) GROUP BY k),
c{n + 1} AS (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m ON c.k = m.k)"""


_FINITE_SQL = "len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"

ORACLES: dict[str, str] = {
    "op11_centroid_clusters": f"""
WITH kept AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::double * 64)::bigint) AS v FROM embeddings
              WHERE len(embedding) = 64 AND {_FINITE_SQL}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, v FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16),
{_round_sql(0)},{_round_sql(1)},{_round_sql(2)},{_round_sql(3)}
SELECT a.vec_id, a.k::int AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::bigint AS cluster_inertia,
       (sum(a.d) OVER ())::bigint AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c ON a.k = c.k""",
    "op12_hard_negatives": f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(x::double * 256)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE_SQL}),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::bigint AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.other AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other))::int AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) <= 5""",
    "op1_exact_dedup": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm)::bigint AS group_size,
       row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256, length(text)::int AS n_chars
FROM t WINDOW best AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)""",
}
