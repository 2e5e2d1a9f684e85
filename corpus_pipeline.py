"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, token output.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a DataFrame; ``run`` stores each result as Parquet in the
shared folder and rereads it as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retail_mart.llm import decontam, langid, mixing, order_minhash, tokens
from retail_mart.llm.common import cut, table
from retail_mart.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is found; learned from the rows that are not held out."""
    return langid.keep_identified(docs, langid.fit(docs, ~langid.held_out()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class."""
    return order_minhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' content per row: (doc_id, start, n_tokens, ids_crc32)."""
    return tokens.encode_corpus(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_weights),
    ("token_output", token_output),
]

# No SQL form (trees, alignments, tokenizers); tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
