"""From raw documents to packed training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm import language, packing, simhash, toxicity
from ticketloom.llm.queries import WORD_TOKENIZER, read_table
from ticketloom.llm.storage import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by a model fitted to the labels of these documents go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def keep_clear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those no language stands out for, go."""
    return language.with_clear_language(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the smallest id stays."""
    return simhash.without_near_duplicates(docs, shingle_words=4, max_bits=4)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and the offset in it."""
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_clear_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("best_fit_packing", pack),
]
# Trained models and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
