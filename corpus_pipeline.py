"""From raw documents to packed training sequences, stage by stage.

Each stage is a function of (spark, docs, sf_dir) over everything the stage
before kept; its result is written as Parquet and read again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from chaffsieve.llm.exact_dedup import drop_exact_copies
from chaffsieve.llm.language import drop_unknown_languages
from chaffsieve.llm.mixing import mixed_stream
from chaffsieve.llm.near_dedup import drop_near_copies
from chaffsieve.llm.packing import pack
from chaffsieve.llm.tables import table
from chaffsieve.sources.staging import delete, passing, scratch_root


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or a leading language go."""
    return drop_unknown_languages(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the one with the largest doc_id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles the smallest doc_id stays."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated and cut to their target shares, in stream order."""
    return mixed_stream(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 2,048."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Sketches, Viterbi and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is on disk before the next begins.

    What a stage needed on its way goes when it is done, and so does the
    result of the stage before.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{scratch_root(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        with passing(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
