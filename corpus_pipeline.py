"""From raw documents to training rows: quality, near-duplicates, personal data, mixing, tokens.

Every stage is a function (spark, docs, sf_dir) to a DataFrame; its result is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``docs``, whatever their names. No stage
loses a row for a null id, another column's name or its copies.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tapeflow.llm import bpe, mixing, neardup, pii, quality
from tapeflow.llm.common import read_table
from tapeflow.session import durable, temporary_tables

#: SQL has no byte-level BPE; the tests hold each stage against a plain version.
ORACLE_SQL = None

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that the quality operator keeps, judging each by its text: null and empty texts go, copies stay or
    go together, an id may be null."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near-duplicates, that with the smallest id (null last); of repeated rows one. All
    rows without words stay."""
    return neardup.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; keeps every row, null and empty texts as they are."""
    return pii.masked(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each row as the mix takes, none to two; a text without words is never taken. Null sources are one
    source, rows with null or equal ids are documents of their own."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, four bytes each), decodes (whether the ids give the text back), a row for each
    row; null and empty texts have no token."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. An empty table gives an empty result. The tables that a stage works with are
    deleted when its result is written."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with temporary_tables(spark):
            docs = durable(stage(spark, docs, sf_dir), temporary=False)
    return docs
