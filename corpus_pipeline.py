"""Corpus pipeline over ``documents``: language ID, exact dedup, near dedup,
source mixing, packing. Every stage is written as Parquet and reread as the next
one's input; all but the last return the columns of ``documents``.

    run(spark, sf_dir)                    the packed pieces, as a DataFrame
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, language_id, mixing, near_dup, packing
from tidemark.session import checkpoint_dir, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID does not reject."""
    return language_id.drop_unknown(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dup.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated so that all sources weigh the same, shuffled."""
    return mixing.replicate(docs, extras=False)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("language_id", known_language), ("exact_dedup", without_copies), ("near_dedup", without_near_copies),
          ("mixing", mixed), ("packing", packed)]

#: Language models, signatures and token ids are not SQL: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = posixpath.join(checkpoint_dir(spark), f"tidemark-pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = posixpath.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
