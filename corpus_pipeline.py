"""Cleaning pipeline over ``documents``: quality rules, line dedup, near-duplicates, secrets, packing.

Each stage is a function of (spark, docs, sf_dir).  All but the last return the columns of
``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lumenrec.llm import line_dedup, near_dup, packing, quality, secret_scan
from lumenrec.llm.common import Scratch

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far out in their language and source go."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that five documents hold stay in the one with the largest id; n_chars follows."""
    return line_dedup.rewrite_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more the one with the smallest id stays."""
    return near_dup.keep_one(docs, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a marker; n_chars follows.  Words are the corpus's own too."""
    return secret_scan.redact_secrets(docs, lang_col="lang")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]
ORACLE_SQL = None      # statistics, sketches and tokenizers are beyond SQL; the tests hold each stage to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to ``documents`` in order, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
