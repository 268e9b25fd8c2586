"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Each source's documents are put in a shuffled line and the line is cut into blocks of equally many words. A source
gets as many slots as its target needs blocks. The slots of all sources lie side by side on the unit interval, as
their cumulative weights do; the schedule visits that interval in the order of the van der Corput sequence (the
binary digits of the slot number, reversed), so that every stretch of the mix holds the sources in nearly the wanted
shares. The k-th visit to a source, counted from the digits without sorting, takes block k of its line, over again
when the line is used up; the last visit stops at the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbcast.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Words per block. Smaller blocks spread long documents further; the words taken do not depend on it.
BLOCK = 1024
#: Rows a bucket of a source's line has on average, and the largest number of buckets as a power of two.
BUCKET_ROWS, MOST_BUCKET_BITS = 512, 16
#: The interval of all slots is joined with the sources in at most 2 ** GRAIN_BITS equal parts.
GRAIN_BITS = 12


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` of the source (in code point order, null behind all others) and ``size`` in words."""
    source = F.col("source").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("key"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(rows: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per source: its size, target, whole words wanted, blocks, slots and the first of its slots.

    A source's share of all words is its weight, but at most ``most`` times its size; what is cut off goes to the
    others by weight. Sorted by size per weight, the common level of the uncut sources is the largest of the levels
    that hold if exactly the sources before a row are cut. The windows run over one row per source.
    """
    by_name = Window.orderBy("key")
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    place = (F.row_number().over(by_name) - 1) % len(weights)
    sources = (
        rows.groupBy("key").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.array(*map(F.lit, weights))[place].cast("long"))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("free", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("level", F.col("free").cast("double") / F.sum("weight").over(behind).cast("double"))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.max("level").over(whole) * F.col("weight")))
        .withColumn("goal", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long")))
    # try_divide and try_mod: a source without words has no slots.
    rounds = F.expr("goal div nullif(source_size, 0)")
    rest = F.expr("try_mod(goal, source_size)")
    slots = F.coalesce(rounds * F.col("blocks") + F.ceil(rest / block), F.lit(0)).cast("long")
    return sources.withColumn("slots", slots).select(
        "key", "source_size", "target", "goal", "blocks", "slots",
        (F.sum("slots").over(by_name.rowsBetween(Window.unboundedPreceding, 0)) - F.col("slots")).alias("first"))


def with_reversed_bits(df: DataFrame, column: str, name: str, bits: int) -> DataFrame:
    """``df`` with the ``bits`` lowest binary digits of a column in reverse order."""
    df = df.withColumn(name, F.col(column))
    for width, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F),
                        (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF)):
        m, x = F.lit(mask), F.col(name)
        # A projection per step: in one expression each step would double the work of all before it.
        df = df.withColumn(name, F.shiftleft(x.bitwiseAND(m), width).bitwiseOR(
            F.shiftrightunsigned(x, width).bitwiseAND(m)))
    return df.withColumn(name, F.shiftrightunsigned(name, 64 - bits))


def points_below(slot: Column, end: Column, digits: Column, bits: int) -> Column:
    """How many of the points of the slots before ``slot`` lie below ``end``; ``digits`` are its reversed bits.

    The points below fall into one interval per binary digit 1 of ``end``; those of an interval with l leading digits
    fixed recur every 2 ** l slots. So the rank of a slot needs no sort and no window.
    """
    def one(count: Column, n: Column) -> Column:
        half = F.call_function("shiftleft", F.lit(1).cast("long"), n - 1)
        hits = F.call_function("shiftright", slot + 2 * half - 1 - digits.bitwiseAND(half - 1), n)
        return count + F.when(digits.bitwiseAND(half) != 0, hits).otherwise(F.lit(0).cast("long"))

    counted = F.aggregate(F.sequence(F.lit(1), F.lit(bits)), F.lit(0).cast("long"), one)
    return F.when(end >= 1 << bits, slot).otherwise(counted)


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix in order: ``slot``, ``key``, ``rank`` among the source's slots, ``block`` and ``words`` taken of it.

    ``sources``: the rows of ``targets``. Slot numbers rise with gaps; each source has exactly its number of slots.
    """
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    bits = max(1, (total - 1).bit_length()) if total else 1
    shift = max(0, bits - GRAIN_BITS)
    parts = max(spark.sparkContext.defaultParallelism, (1 << bits) >> 22)
    slots = spark.range(0, 1 << bits if total else 0, 1, parts).select(F.col("id").alias("slot"))
    slots = with_reversed_bits(slots, "slot", "point", bits).where(F.col("point") < total).withColumn(
        "grain", F.shiftright("point", shift))
    lasting = sources.where("slots > 0").withColumn("end", F.col("first") + F.col("slots"))
    for end in ("first", "end"):
        lasting = with_reversed_bits(lasting, end, f"{end}_digits", bits)
    spread = lasting.withColumn(
        "grain", F.explode(F.sequence(F.shiftright("first", shift), F.shiftright(F.col("end") - 1, shift))))
    met = slots.join(spread, "grain").where("point >= first AND point < end")
    below = [points_below(F.col("slot"), F.col(e), F.col(f"{e}_digits"), bits) for e in ("end", "first")]
    rank = below[0] - below[1]
    ranked = met.withColumn("rank", rank).withColumn("block", F.col("rank") % F.col("blocks"))
    done = F.expr("rank div blocks") * F.col("source_size") + F.col("block") * block
    words = F.least(F.lit(block), F.col("source_size") - F.col("block") * block, F.col("goal") - done)
    return ranked.select("slot", "key", "rank", "block", words.cast("long").alias("words"))


def lined_up(rows: DataFrame) -> DataFrame:
    """The rows with ``start``, their first word's place in the shuffled line of their source.

    The line follows md5 of ``doc_id``; of equal ones the smaller document comes first. A source is summed in up to
    2 ** 16 buckets of that order, so that no task sorts a whole source.
    """
    n = rows.count()
    bits = min(MOST_BUCKET_BITS, max(0, (n // BUCKET_ROWS).bit_length()))
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    number = F.conv(F.substring("mark", 1, 4), 16, 10).cast("long")
    marked = rows.withColumn("mark", mark).withColumn("bucket", F.shiftright(number, 16 - bits))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = marked.groupBy("key", "bucket").agg(F.sum("size").alias("s")).select(
        "key", "bucket", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("key", "bucket").orderBy("mark", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = marked.join(starts, ["key", "bucket"])
    return placed.select("doc_id", "key", "size",
                         (F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("start"))


def mixed(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, block: int = BLOCK
) -> DataFrame:
    """How much of each document the mix takes.

    ``docs``: ``doc_id``, ``source``, ``text``; other columns are ignored. Result, one row per input row: ``doc_id``,
    ``size`` (words; null text: 0), ``source_size`` and ``target`` of its source, ``taken``: words the schedule takes
    of it, repeats counted. The words of a source add up to its target, rounded; no document is taken more than
    ``most`` times. Null is a source of its own, behind all others. Documents without words are never taken. Rows
    that repeat a ``doc_id`` are documents of their own. An empty table gives an empty result.
    """
    rows = stored(sized(docs), "sizes")
    sources = stored(targets(rows, weights, most, block), "targets")
    visits = schedule(sources, block).join(sources.select("key", "source_size"), "key").withColumn(
        "length", F.least(F.lit(block), F.col("source_size") - F.col("block") * block))
    # Of a block's visits at most one, the source's last, is cut short.
    full = F.col("words") == F.col("length")
    visited = visits.groupBy("key", "block").agg(
        F.count_if(full).alias("times"), F.coalesce(F.max(F.when(~full, F.col("words"))), F.lit(0)).alias("part"))

    line = lined_up(rows)
    parts = line.where("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    low = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    words = F.col("times") * (high - low) + F.greatest(F.least(high, F.col("part")) - low, F.lit(0))
    taken = parts.join(visited, ["key", "block"], "left").groupBy("key", "start", "doc_id", "size").agg(
        F.coalesce(F.sum(words), F.lit(0)).alias("taken"))
    every = taken.select("doc_id", "key", "size", "taken").unionByName(
        rows.where("size = 0").select("doc_id", "key", "size", F.lit(0).cast("long").alias("taken")))
    return every.join(sources.select("key", "source_size", "target"), "key").select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))
