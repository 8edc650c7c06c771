"""A corpus pipeline of five stages over the documents table.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet in the shared
folder and read again as the next one's docs. All stages but the last return the columns of
documents. Language ID drops texts without a language (null or no letter), the quality
classifier drops texts scored under its cut, the n-gram join leaves one document of each class of
near duplicates, the secret scan masks what it finds, packing returns a row per packed piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm import language, ngram_join, packing, quality, secret_scan
from tabrisk.llm.common import table, write_stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found, by profiles of the rows outside fold 2 of 4."""
    docs = docs.select(*COLUMNS)
    got = language.predict(docs, language.fit(docs.where(~language.held_out())))
    return got.where(F.col("lang_pred") != "und").select(*COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_join.one_per_class(docs.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.mask(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("mask_secrets", mask_secrets),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Models, tokenizers and packing can't be expressed in SQL; tests compare with a plain version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
