"""The corpus pipeline: stages applied to ``documents`` one after another.

Each stage calls one operator of ``pitwall.llm`` on all that its predecessor
kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import language, lines, mixing, packing, simhash
from pitwall.llm.common import table
from pitwall.session import ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return language.reject(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; every document stays."""
    return lines.strip(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal SimHash fingerprints stays."""
    return simhash.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix takes, sorted by training position."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("simhash", dedup_documents),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# SQL has no tokenizer, no fingerprint and no fitted model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
