"""Corpus pipeline: quality rules, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of ``documents``; the last returns the packing plan.
Stages are written as Parquet and read again in between. Empty tables, nulls
and extra columns pass as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staffmart.llm import line_dedup, mix, near_dups, packing, quality
from staffmart.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified rule rejects go."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least three documents hold stay in one of them."""
    return line_dedup.without_shared_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dups.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that the sources' weights ask for."""
    return mix.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bucket, batch and slot of every row."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", shared_lines),
    ("near duplicates", near_duplicates),
    ("mix sources", mix_sources),
    ("pack", pack),
]

# Exact binomial tests, near-duplicate classes and the optimal buckets are not
# expressible in SQL; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{i + 1}")
    return docs
