"""A training-corpus pipeline: five stages, each one operator of ``tessera.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps,
with the columns of ``documents``; its result is written as Parquet and read
again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, exact_dedup, mixing, simhash, toxicity
from tessera.llm.common import staged, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-equal fingerprints link."""
    return simhash.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target weights of sources, languages and topics."""
    return mixing.sample(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: The classifier and the fingerprints are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
