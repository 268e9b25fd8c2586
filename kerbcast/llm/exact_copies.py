"""Exact duplicates by heavy-hitter split, in DataFrame operations only.

A first pass writes a digest per row. Misra-Gries counting (Spark's frequent items) names every digest that
holds more than a given share of the rows; their groups are counted exactly with map-side combination, and the
verified winners, at most one per unit of that share, are broadcast and joined where the rows lie. All other
digests are rarer than the share, so an ordinary shuffle spreads them evenly.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbcast.llm.common import stored

#: Digests above this share of the rows are treated apart; bounds the broadcast to its reciprocal of rows.
HEAVY_SHARE = 1 / 4096


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character unchanged. Pure ASCII takes the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def digest(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), 256)


def copy_groups(docs: DataFrame, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """The group of equal texts of each document and the row that stays.

    ``docs``: ``doc_id``, ``text``; other columns are ignored. Texts are equal when identical after
    lower-casing A-Z; null counts as empty. Result, one row per input row: ``doc_id``, ``keep_id`` (largest
    ``doc_id`` of the group; a null is smaller than any number), ``group_size``, ``kept``, ``text_sha256``. Of
    repeated rows with the same largest ``doc_id`` exactly one is kept. An empty table gives an empty result.
    """
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row")), "digests")
    frequent = rows.stat.freqItems(["text_sha256"], heavy_share).toDF("items").select(
        F.explode("items").alias("text_sha256"))
    best, size = F.max(F.struct("doc_id", "row")), F.count(F.lit(1))
    winners = (rows.join(F.broadcast(frequent), "text_sha256", "left_semi")
               .groupBy("text_sha256").agg(best.alias("best"), size.alias("group_size")))
    winners = stored(winners, "frequent_digests")

    marked = rows.join(F.broadcast(winners), "text_sha256", "left")
    heavy = marked.where(F.col("group_size").isNotNull())
    group = Window.partitionBy("text_sha256")
    light = (rows.join(F.broadcast(winners), "text_sha256", "left_anti")
             .withColumn("best", best.over(group)).withColumn("group_size", size.over(group)))
    return heavy.unionByName(light).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """``docs`` with all its columns and only the rows that ``copy_groups`` keeps. Of rows that repeat both
    ``doc_id`` and text one stays, whichever it is in their other columns."""
    def named(sha: Column) -> Column:
        return F.concat_ws(":", sha, F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null"))).alias("mark")

    # Only rows of groups with copies can go or repeat; the texts of all others are not moved for them.
    marks = copy_groups(docs, heavy_share).where("group_size > 1").select(named(F.col("text_sha256")), "kept")
    copies = stored(marks.groupBy("mark").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows"))
                    .where("NOT stays OR rows > 1").select("mark", "stays"), "copies")
    rows = docs.select(named(digest(F.col("text"))), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("entry"))
    found = rows.join(copies, "mark", "left")
    alone = found.where("stays IS NULL").select("entry.*")
    if copies.where("stays").isEmpty():
        return alone
    return alone.unionByName(found.where("stays").dropDuplicates(["mark"]).select("entry.*"))
