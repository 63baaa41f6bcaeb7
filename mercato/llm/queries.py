"""The registered queries ``opN_<name>`` and the pipeline, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from mercato.llm import byte_bpe, chat, decontam, fingerprint, jaccard_join, language, line_dedup, lm_score, mixing, periodic, quality, secrets, whitening
from mercato.llm.text import documents

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_report(documents(spark, sf_dir))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(documents(spark, sf_dir))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").cast(conversations.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(control)
    return chat.chat_report(rows)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_documents(documents(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_report(documents(spark, sf_dir))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.runs_report(documents(spark, sf_dir))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip_report(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


OPERATORS = (
    op1_document_fingerprints,
    op2_benchmark_decontamination,
    op3_language_id,
    op4_quality_classifier,
    op5_line_dedup,
    op6_source_mixing,
    op7_chat_formatting,
    op8_jaccard_join,
    op9_secret_scan,
    op10_lm_scoring,
    op11_periodic_runs,
    op12_embedding_whitening,
    op13_byte_bpe,
)


def llm_queries() -> dict[str, QueryFn]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in OPERATORS}


def llm_oracles() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return pipeline | {"op7_chat_formatting": chat.CHAT_SQL, "op10_lm_scoring": lm_score.LM_SQL}
