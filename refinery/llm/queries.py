"""The queries of this folder by name, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import (
    ball_tree,
    boosted_toxicity,
    conflict_packing,
    digest_index,
    hard_negatives,
    ordinal_quality,
    piece_count,
    rank_bpe,
    tensor_dedup,
    token_store,
    warc,
    whitening,
    word_language,
)
from refinery.llm.common import table


def op1_tensor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensor_dedup.near_groups(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conflict_packing.pack(table(spark, sf_dir, "documents"))


def op3_piece_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_count.count_report(table(spark, sf_dir, "documents"))


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return ordinal_quality.quality_report(docs, labels)


def op5_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"))


def op6_word_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_language.language_report(table(spark, sf_dir, "documents"))


def op7_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return boosted_toxicity.toxicity_report(docs, labels)


def op8_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.coding_report(table(spark, sf_dir, "documents"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.roundtrip(table(spark, sf_dir, "documents"))


def op10_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.exact_report(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_segmented_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op13_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_tensor_dedup, op2_conflict_packing, op3_piece_count, op4_ordinal_quality, op5_ball_tree,
        op6_word_language, op7_boosted_toxicity, op8_rank_bpe, op9_token_store, op10_digest_index,
        op11_hard_negatives, op12_segmented_warc, op13_qd_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op5_ball_tree": ball_tree.ORACLE,
    "op10_digest_index": digest_index.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_segmented_warc": warc.ORACLE,
}
