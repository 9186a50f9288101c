"""A corpus pipeline of five stages over ``documents``; each works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contigframe.llm import exact_dedup, jaccard_join, language_id, mixing, packing, util


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in none of the learnt languages, go."""
    return language_id.identified_documents(docs, language_id.learn(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out as the sources' target weights ask for."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of fixed length. Executors are full by then, of what the stages before have left in their heaps."""
    return packing.pack(docs, low_memory=True)


STAGES = [("language ID", language), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing sources to target weights", mix), ("packing", pack)]

#: No SQL expresses the trained, hashed and tokenized stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is a written table that the next one reads."""
    docs = util.documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = util.written(docs, f"stage{k}")
    return docs
