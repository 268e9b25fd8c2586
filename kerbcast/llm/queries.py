"""Registered queries: each text operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.llm import (
    conversations, divergence, exact_copies, fingerprints, html_text, language, mixing, near_copies, packing,
    personal_data, pieces, pitman_yor, quality,
)
from kerbcast.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(spans: str, kinds: tuple[str, ...] | None = None) -> F.Column:
    """``kind:start:end`` of the spans (of the kinds), joined by commas."""
    chosen = F.col(spans)
    if kinds:
        chosen = F.filter(chosen, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
              for k in personal_data.BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined("spans", personal_data.BASE_KINDS), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))


@query
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                          with_ids=False)


def remainder(divisor: int) -> F.Column:
    """crc32 of ``doc_id`` written as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def held_out(divisor: int) -> F.Column:
    return F.coalesce(remainder(divisor) == 1, F.lit(False))


@query
def op4_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.copy_groups(table(spark, sf_dir, "documents"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(3) != 1)
    return scored.select("doc_id", held_out(3).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.languages(table(spark, sf_dir, "documents"), remainder(3) != 1)
    return found.select("doc_id", held_out(3).alias("held_out"), "lang_pred", "score")


@query
def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_groups(table(spark, sf_dir, "documents"), words=3, percent=85)


@query
def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = pitman_yor.scored(table(spark, sf_dir, "documents"), remainder(5) != 1)
    return scores.select("doc_id", held_out(5).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")), F.col("present"))
