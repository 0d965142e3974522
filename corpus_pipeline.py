"""A corpus pipeline of training-data operators, as registered query ``pipeline``.

Documents of poor quality go, then those whose language is not clear; one
document of each near-duplicate group stays; the mix of domains is brought to
its target weights; the rest is packed into sequences of 1,024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from knnrec.llm import jaccard_tree, langid, mixing, packing, quality_fm
from knnrec.llm.common import stage


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose quality score is at least 0.3."""
    return quality_fm.keep_good(docs, quality_fm.learn(docs, labels(spark, sf_dir)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a clear language (a letter, and a lead)."""
    return langid.keep_identified(docs, langid.learn(langid.training_rows(docs)))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by 0.8 of their five-word shingles."""
    return jaccard_tree.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that domain tokens match the targets."""
    return mixing.apply_mix(docs, labels(spark, sf_dir))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses none of the stages; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
