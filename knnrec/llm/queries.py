"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knnrec.llm import chat, embedding_lsh, exact_dedup, jaccard_tree, langid, lm_hpy, mixing, packing, prefix_trie, quality_fm, quality_rules, toxicity, whitening
from knnrec.llm.common import fold
from knnrec.llm.oracle import ORACLES  # noqa: F401  read by __spark_entry__


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_lsh.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tree.join(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("failed_rules")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_fm.learn(docs, table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    links = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, links).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_hpy.score(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.classify(table(spark, sf_dir, "documents"))
    return found.withColumn("held_out", fold(F.col("doc_id"), 4) == 2)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.windows(rows))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_best_fit_packing, op2_embedding_near_dedup, op3_source_mixing, op4_ngram_jaccard_join, op5_quality_rules, op6_quality_classifier, op7_toxicity, op8_lm_scoring, op9_language_id, op10_chat_formatting, op11_embedding_whitening, op12_exact_dedup, op13_conversation_trie)
}
