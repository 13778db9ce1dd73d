"""The corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input.

A stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of ``documents``; the last one returns the encoded documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingflow.llm import bpe, language_id, line_dedup, mixing, simhash
from filingflow.llm.common import work_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from a bounded sample of the labelled documents; rejected documents go."""

    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_accepted(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 25 words or more go; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs, min_words=25)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: 4-word shingles, 4 bits; one document of each group stays."""
    return simhash.keep_one(docs, simhash.near_duplicates(docs, words_per_shingle=4, max_bits=4))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, the rarest source at most twice."""
    units = docs.select("doc_id", "source", mixing.word_tokens(F.col("text")).alias("tokens"))
    return mixing.realise(docs, mixing.mix(units, repetition_limit=2.0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every row: the token ids, their number and digest, digest of the decoded bytes."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

#: Language models, XXH64 fingerprints and BPE merges have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
