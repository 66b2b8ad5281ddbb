"""One query per operator over the given tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import (
    bpe_codec,
    conversation_repair,
    embedding_dedup,
    huffman_ids,
    license_scan,
    line_dedup,
    minhash,
    mixing,
    quality_rules,
    resample,
    secret_scan,
    token_alignment,
    token_counts,
)
from tripflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
GOOD = "quality = 1 and toxic = 0"
DOMAIN = "case when toxic = 1 then 'toxic' when quality = 0 then 'low' else 'good' end"
MIX = {"good": 0.996, "low": 0.002, "toxic": 0.002}


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, "source", "text", dropped_col="n_dropped").drop("source")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_rates(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "text", DOMAIN, MIX, "good"
    )
    return found.select("doc_id", "n_tokens", "p", "rate", "copies")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_scan.secret_spans(table(spark, sf_dir, "documents"), "doc_id", "text")
    return secret_scan.span_digests(spans)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.similar_components(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.codec_digests(table(spark, sf_dir, "documents"), "doc_id", "text", BYTE_BPE)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_verdicts(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "text", "quality"
    )
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", PIECES)


def op9_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman_ids.ids_round_trip(table(spark, sf_dir, "documents"), "doc_id", "text", WORD_BPE, END_ID)


def op10_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "text", GOOD
    ).select("doc_id", "kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.damage_and_repair(rows, "conv_id", "turn", "role", "text")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_digests(table(spark, sf_dir, "documents"), "doc_id", "text", BYTE_BPE, PIECES)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"), "doc_id", "text")
    return license_scan.license_labels(found, "doc_id")


def llm_queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_mix_sources": op2_mix_sources,
        "op3_secret_scan": op3_secret_scan,
        "op4_embedding_dedup": op4_embedding_dedup,
        "op5_bpe_codec": op5_bpe_codec,
        "op6_minhash_dedup": op6_minhash_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_token_counts": op8_token_counts,
        "op9_huffman_ids": op9_huffman_ids,
        "op10_quality_resample": op10_quality_resample,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_token_alignment": op12_token_alignment,
        "op13_license_scan": op13_license_scan,
    }


def llm_oracles() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE}
