"""From raw documents to packed training sequences: five stages, each stored before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import language, mixing, near_texts, packing, quality
from sievework.llm.tables import given, stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, rejects go."""
    return quality.good_documents(docs, given(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go."""
    return language.known_documents(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words a shingle, similarity 0.8."""
    return near_texts.without_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents are repeated or left out."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences; workers have other stages' memory besides."""
    return packing.pack(docs, keep_ids=False, remembered=96 << 20).drop("ids")


STAGES = [
    ("quality classifier", good),
    ("language ID", known_language),
    ("MinHash near-dedup", distinct),
    ("mixing sources", mixed),
    ("packing", packed),
]

# Learned models and approximate joins are not expressible in SQL; tests hold the run against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; a stage's rows are stored in the shared folder and read again by the next."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
