"""Registered queries opN_<name>: each applies its operator to its whole table; digests are made here."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import format_chats
from .langid import held_out, identify, train
from .merkle import joined_hex, manifest
from .packing import pack
from .pieces import encode_decode
from .quality import quality_verdicts
from .quality_pu import score_quality
from .records import token_records
from .simhash import near_duplicates
from .substring_dedup import duplicate_spans
from .token_counts import token_counts
from .topk import top_k
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = duplicate_spans(table(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_stop_words")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.where("vec_id % 20 = 0"), vectors, k=20, scale=64.0)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=2048)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lower)
    made = manifest(table(spark, sf_dir, "documents"), probe=("text", tampered))
    return made.select("doc_id", *[F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")],
                       F.sha2(joined_hex(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
                       F.lower(F.hex("folded_root")).alias("folded_root"), "verified")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=16, scale=64.0, offset=1_000_000)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_chat_format": op3_chat_format,
    "op4_token_records": op4_token_records,
    "op5_simhash": op5_simhash,
    "op6_language_id": op6_language_id,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_packing": op10_packing,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}
