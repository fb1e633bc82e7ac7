"""From raw documents to packed training sequences.

STAGES are applied in order; each works on every row that the stage before it kept, and its result
is written as Parquet and read back before the next. All but the last return the columns of
``documents``. Empty tables pass through every stage; how nulls, ties and repeated rows are treated
stands with each operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import read_table, written
from tessera.llm.exact_dedup import drop_exact_copies
from tessera.llm.jaccard_join import drop_near_copies
from tessera.llm.packing import pack_documents
from tessera.llm.pii import redact_personal_data
from tessera.llm.quality_classifier import keep_good_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier scores below 0.5."""
    return keep_good_documents(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return drop_near_copies(docs, n=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by the name of its kind."""
    return redact_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens; one row per piece."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("personal data", personal_data),
    ("best-fit packing", packing),
]

#: Training a classifier and tokenizing cannot be written in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
