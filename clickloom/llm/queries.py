"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    fingerprints,
    language,
    lines,
    neardup,
    packing,
    passages,
    quality_rules,
    quality_trees,
    secrets,
    sentencepieces,
    vector_codes,
    warc,
    whitening,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepieces(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.encode_documents(_table(spark, folder, "documents"), _vocabulary("piece_bpe_32k.model"))


def op2_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    return quality_trees.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_rare_features(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, folder, "documents"))


def op4_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    return warc.page_records(_table(spark, folder, "pages"))


def op5_bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"))


def op6_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_documents(_table(spark, folder, "documents"))


def op7_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), _vocabulary("word_bpe_49k.json"))


def op8_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge_documents(_table(spark, folder, "documents"))


def op9_linked_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_documents(_table(spark, folder, "documents")).drop("findings")


def op10_chained_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.shared_passages(_table(spark, folder, "documents"))


def op11_block_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def op12_hashed_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup_lines(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_ball_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress_vectors(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepieces": op1_sentencepieces,
    "op2_quality_trees": op2_quality_trees,
    "op3_rare_features": op3_rare_features,
    "op4_warc_members": op4_warc_members,
    "op5_bottom_k": op5_bottom_k,
    "op6_language_mixture": op6_language_mixture,
    "op7_harmonic_packing": op7_harmonic_packing,
    "op8_divergence_rules": op8_divergence_rules,
    "op9_linked_secrets": op9_linked_secrets,
    "op10_chained_passages": op10_chained_passages,
    "op11_block_whitening": op11_block_whitening,
    "op12_hashed_lines": op12_hashed_lines,
    "op13_ball_codes": op13_ball_codes,
}

SQL: dict[str, str] = {
    "op4_warc_members": warc.SQL,
    "op9_linked_secrets": secrets.SQL,
    "op12_hashed_lines": lines.SQL,
    "op13_ball_codes": vector_codes.SQL,
}
