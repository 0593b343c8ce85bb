"""The documents of a training corpus, stage by stage: each stage reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldspark.llm import best_fit, content_sort, decontaminate, language, metric_join
from fieldspark.llm.common import landed, quoted, workspace
from fieldspark.llm.queries import language_model


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or without a letter go: no language can be told."""
    columns = [quoted(c) for c in docs.columns]
    return language.identify(docs, language_model(docs)).where("lang_pred <> 'und'").select(*columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier stays."""
    return content_sort.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.8 or more of their five-word shingles the smallest identifier stays."""
    return metric_join.drop_near(docs, width=5, percent=80)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens stand in sequences of 2048."""
    return best_fit.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", near_dedup),
    ("decontamination", decontaminate_benchmark),
    ("best_fit_packing", pack_sequences),
]

#: Language identification and tokens cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), folder, name)
    return docs
