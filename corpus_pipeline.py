"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the last one
returns the pieces of packed sequences. Stages neither sample nor cut; what one rejects does not reach the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.llm import exact_copies, language, near_copies, packing, personal_data
from kerbcast.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: A text in which no language reaches this share of its words has no main language.
LEAST_SHARE = 0.4


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a main language: null texts, texts without a letter, mixtures without one."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    return language.in_language(docs, learn, least=LEAST_SHARE)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts, the one with the largest id."""
    return exact_copies.without_copies(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar ones (five-word shingles, 0.8), the one with the smallest id."""
    return near_copies.without_near_copies(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; all documents stay and ``n_chars`` follows the text."""
    return personal_data.without_personal_data(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def sequenced(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identified), ("exact_copies", deduplicated), ("near_copies", distinct),
    ("personal_data", masked), ("packing", sequenced),
]
#: Language ID, near duplicates and packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
