"""From documents to packed training sequences, in five stages.

Each stage works on all rows its predecessor kept and returns the columns of ``documents`` (the last returns
pieces). ``run`` writes every stage as Parquet in the shared folder and reads it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admart.llm.common import materialize
from admart.llm.langid import UNKNOWN, identify, train
from admart.llm.packing import pack
from admart.llm.quality import quality_verdicts
from admart.llm.simhash import near_duplicates
from admart.llm.substring_dedup import duplicate_spans

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: null texts and texts without a letter go. A document without ``lang`` gets the predicted one."""
    named = identify(docs, train(docs), keep=("text", "lang", "source", "n_chars"))
    lang = F.coalesce("lang", "lang_pred").alias("lang")
    return materialize(named.where(F.col("lang_pred") != UNKNOWN).select("doc_id", "text", lang, "source", "n_chars"), "language")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule."""
    return quality_verdicts(docs, keep=("text", "lang", "source", "n_chars")).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of SimHash near-duplicates.

    Documents stand by doc_id and text: where a group holds several texts of its smallest doc_id, the one with the
    least hash stays, and a doc_id that stands for texts of several groups is judged in each. Of the rows without
    doc_id, which no named row replaces, one of each group stays. Of repeated rows (same doc_id and text) one stays.
    """
    content = [F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"]
    tagged = docs.select(*COLUMNS, F.xxhash64(*content).alias("tag"), F.xxhash64(F.lit("second"), *content).alias("tag2"))
    found = near_duplicates(tagged, shingle=3, radius=3, keep=("tag", "tag2"))
    chosen = (found.groupBy("root", F.col("doc_id").isNull().alias("unnamed"))
              .agg(F.min(F.struct("doc_id", "tag", "tag2")).alias("one")).select("one.tag", "one.tag2"))
    # Repeated rows go before texts are dealt, by the key of the join, so texts are dealt once.
    return tagged.dropDuplicates(["tag", "tag2"]).join(chosen, ["tag", "tag2"], "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that windows of 13 repeat from earlier documents; emptied documents go."""
    found = duplicate_spans(docs, window=13, keep=("lang", "source", "n_chars"), unchanged=True)
    left = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return materialize(left.select("doc_id", F.col("kept").alias("text"), "lang", "source", n_chars.alias("n_chars")), "substrings")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 ids."""
    packed = pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=2048)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


#: SQL can express neither the language model, nor SimHash, nor the tokenizer; tests hold run() against brute force.
ORACLE_SQL = None
