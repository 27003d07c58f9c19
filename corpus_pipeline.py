"""The corpus pipeline: language, quality, near-duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its result is written as
Parquet and read again as the next one's documents. All but the last keep the columns of ``documents``.

Rejected rows: a text without letters, which op9 marks ``und``, and no other for its language; a text the quality model scores
below its threshold; all but one document of a near-duplicate group; a document that holds a benchmark passage.
Null texts go in the first stage; null ids and repeated rows are handled as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airledger.llm import bpe_codec, decontaminate, language, quality, simhash
from airledger.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs, language.train(docs))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_enough(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_codec.encoded_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# Trained models, 64-bit hashes and merge ranks are outside SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
