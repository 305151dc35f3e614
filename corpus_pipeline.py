"""Documents to packed training sequences.

Quality rules drop documents, one document of each class of near copies stays, secrets are
replaced by their kind, sources are mixed to their target weights (documents may come
twice, or cut), and the mix is tokenized and packed. Every stage works on all that the one
before it kept.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from hearthlog.llm import (  # noqa: E402
    jaccard_join,
    packing,
    quality_rules,
    secret_scan,
    source_mixing,
)
from hearthlog.llm.queries import BYTE_BPE  # noqa: E402
from hearthlog.llm.worker import park  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.good_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each_class(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.without_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("secret scan", secrets),
    ("source mixing", mixing),
    ("packing", pack),
]

#: Tokenization, checksums of secrets and near copies have no SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result parked for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        result = stage(spark, docs, sf_dir)
        if number == len(STAGES):
            return result
        docs = park(result, f"pipeline-{number}")
