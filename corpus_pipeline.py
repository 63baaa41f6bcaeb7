"""The training-data pipeline: ``documents`` through five stages, each written as Parquet and read again.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns the documents it keeps, with the columns of ``documents`` (the last
one adds ``size`` and ``copy``).  ``run`` applies them in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.functions.common import reuse_checkpointed
from mercato.llm import decontam, jaccard_join, language, line_dedup, mixing
from mercato.llm.text import documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go."""
    return language.accepted_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and documents that lose all their words."""
    return line_dedup.documents_left(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return jaccard_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
]

# Trained models, components and knapsacks have no SQL form: tests/llm checks the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = reuse_checkpointed(docs)
    return docs
