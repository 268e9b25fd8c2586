"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A document is a weighted set: its two-word terms with the times they occur. For each of ``samples`` draws, a
term's hash yields two gamma variates r, c and a uniform b; with weight S, t = floor(ln S / r + b), and the
term's value is ln c - r (t - b + 1). The least value over the terms names the drawn (term, t): two documents
draw the same one with a probability equal to their generalised Jaccard similarity. As the value depends on
term and t alone, the least value itself is the sample, and its hash is what the fingerprint keeps.

Documents are put in the order of ``doc_id`` by buckets whose first ids come from an approximate quantile
sketch. The first document of a bucket visits the bucket before it as a guest, so each document meets its
next one without a second shuffle of texts, and all sums of a document are taken where it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbcast.llm.common import texts_of

SAMPLES = 32
#: Hexadecimal digits kept of each sample; unequal samples agree by chance once in 16 ** DIGITS.
DIGITS = 8
#: Buckets per shuffle partition; several, so that partitions get even shares.
BUCKETS_EACH = 8


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def weighted_terms(text: Column) -> Column:
    """Array of (term, weight): hashes of two neighbouring words (or of the only word) and their counts."""
    words = F.filter(F.split(text, "[ \t-\r]+"), lambda w: w != "")
    hashed = bound(words, lambda w: F.when(F.size(w) == 1, F.transform(w, lambda x: F.xxhash64(x))).otherwise(
        F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                   lambda x, y: F.xxhash64(x, y))))
    # Equal terms lie together after sorting; the last of each run ends where its count is known.
    def runs(h: Column) -> Column:
        ends = F.filter(F.transform(h, lambda x, i: F.when(
            (i + 1 == F.size(h)) | (F.get(h, i + 1) != x), i + 1)), lambda e: e.isNotNull())
        return bound(ends, lambda e: F.transform(e, lambda stop, i: F.struct(
            F.get(h, stop - 1).alias("term"),
            (stop - F.when(i == 0, F.lit(0)).otherwise(F.get(e, i - 1))).cast("double").alias("weight"))))

    return bound(F.sort_array(hashed), runs)


def uniform(bits: Column, shift: int, width: int) -> Column:
    """A number strictly between 0 and 1 from ``width`` bits."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part.cast("double") + 0.5) / float(1 << width)


def sample_value(term: Column, log_weight: Column, i: int) -> Column:
    """The value of a term in draw ``i``; the least one is the sample."""
    first, second = F.xxhash64(term, F.lit(2 * i)), F.xxhash64(term, F.lit(2 * i + 1))
    r = -F.ln(uniform(first, 0, 32) * uniform(first, 32, 32))
    c = -F.ln(uniform(second, 0, 24) * uniform(second, 24, 24))
    b = uniform(second, 48, 16)
    return F.ln(c) - r * (F.floor(log_weight / r + b).cast("double") - b + 1.0)


def numbers(values: list[int]) -> Column:
    """One constant array, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def bucket_of(key: Column, firsts: list[int]) -> Column:
    """Number of the bucket, from the last id down: ``firsts`` (ascending) are the largest ids of the buckets.
    Found in two steps that look at the square root of the firsts each."""
    step, last = max(1, int(len(firsts) ** 0.5)), len(firsts) - 1
    heads = numbers([firsts[min(i + step, len(firsts)) - 1] for i in range(0, len(firsts), step)])
    group = F.size(F.filter(heads, lambda x: x < key))
    inside = F.size(F.filter(F.slice(numbers(firsts), group * step + 1, F.lit(step)), lambda x: x < key))
    return F.lit(last) - F.least(group * step + inside, F.lit(last))


def with_next(docs: DataFrame, buckets_each: int = BUCKETS_EACH) -> DataFrame:
    """``bucket``, ``place`` (from 1 within the bucket), ``guest``, ``doc_id``, ``text``, ``next_text``: every
    document with the text of the next one by descending ``doc_id``, after the last the first. The last row of a
    bucket is a guest: the first document of the following bucket, once more."""
    spark = docs.sparkSession
    rows = texts_of(docs).select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"))
    wanted = max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * buckets_each
    cuts = [i / wanted for i in range(1, wanted + 1)]
    found = rows.select(F.percentile_approx("key", cuts, 10 * wanted).alias("firsts"), F.max("key").alias("top")).first()
    if found["top"] is None:
        firsts = [0]
    else:
        firsts = sorted({*found["firsts"], found["top"]})
    last = len(firsts) - 1
    own = bucket_of(F.col("key"), firsts)
    # Each first id is one of the rows'; its row also goes to the bucket before (of the first one: the last).
    is_first = F.col("key") == F.get(numbers(firsts), F.lit(last) - F.col("own"))
    before = F.when(F.col("own") == 0, F.lit(last)).otherwise(F.col("own") - 1)
    placed = rows.withColumn("own", own).select(
        "doc_id", "text", "key", F.explode(F.when(is_first, F.array(
            F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest")),
            F.struct(before.alias("bucket"), F.lit(True).alias("guest")))).otherwise(F.array(
                F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest"))))).alias("at"))
    flat = placed.select(F.col("at.bucket").alias("bucket"), F.col("at.guest").alias("guest"), "doc_id", "text", "key")
    order = Window.partitionBy("bucket").orderBy("guest", F.col("key").desc(), F.xxhash64("text"))
    return flat.select("bucket", F.row_number().over(order).alias("place"), "guest", "doc_id", "text",
                       F.lead("text").over(order).alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half (rounded down) replaced by as much of the next one's beginning."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(next_text, half))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal samples; two documents without terms are alike, one without is unlike any with."""
    same = F.aggregate(F.zip_with(one, other, lambda x, y: x.eqNullSafe(y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(one).cast("double")


def fingerprinted(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how like they are.

    ``docs``: ``doc_id``, ``text`` (null: empty); other columns are ignored. Result, one row per input row:
    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (``DIGITS`` hexadecimal
    digits per sample; a text without terms has dashes), ``near_edited``, ``near_next``. Words lie between
    white space (space, tab to carriage return) and keep their case. The next document is the one with the next
    smaller ``doc_id``; a null id counts as smallest; rows with equal ids are ordered by a hash of their text,
    so repeated rows follow each other. A single row is its own next document. An empty table gives an empty
    result.
    """
    rows = with_next(docs)
    flagged = rows.withColumn("edited", F.when(~F.col("guest"), edited(F.col("text"), F.col("next_text"))))
    # Three rows per document: facts without terms, the text's terms, the edited text's terms. Facts are group
    # keys that are null in the other two, so everything stays in the partition of the document's bucket.
    fact = F.struct(F.col("guest"), F.col("doc_id"), F.char_length("text").cast("long").alias("n_chars"),
                    F.sha2("edited", 256).alias("edited_sha256"))
    nothing = F.lit(None).cast("struct<guest:boolean,doc_id:bigint,n_chars:bigint,edited_sha256:string>")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), body.alias("body"), f.alias("fact")) for k, body, f in (
        (0, F.lit(""), fact), (1, F.col("text"), nothing), (2, F.coalesce("edited", F.lit("")), nothing))])
    each = flagged.select("bucket", "place", F.explode(kinds).alias("one")).select("bucket", "place", "one.*")
    terms = each.select("bucket", "place", "kind", "fact.*", F.inline_outer(weighted_terms(F.col("body"))))
    logged = terms.withColumn("log_weight", F.ln("weight")).drop("weight")
    least = logged.groupBy("bucket", "place", "kind", "guest", "doc_id", "n_chars", "edited_sha256").agg(
        *[F.min(sample_value(F.col("term"), F.col("log_weight"), i)).alias(f"s{i}") for i in range(samples)])
    digits = [F.when(F.col(f"s{i}").isNull(), F.lit("-" * DIGITS)).otherwise(
        F.right(F.lpad(F.hex(F.xxhash64(f"s{i}")), 16, "0"), F.lit(DIGITS))) for i in range(samples)]
    prints = least.select("bucket", "place", "kind", F.struct("guest", "doc_id", "n_chars", "edited_sha256").alias("fact"),
                          F.array(*digits).alias("samples"))
    whole = prints.groupBy("bucket", "place").agg(
        F.first(F.when(F.col("kind") == 0, F.col("fact")), ignorenulls=True).alias("fact"),
        F.first(F.when(F.col("kind") == 1, F.col("samples")), ignorenulls=True).alias("own"),
        F.first(F.when(F.col("kind") == 2, F.col("samples")), ignorenulls=True).alias("edit"))
    order = Window.partitionBy("bucket").orderBy("place")
    whole = whole.select("fact.*", "own", "edit", F.lead("own").over(order).alias("following"))
    return whole.where(~F.col("guest")).select(
        "doc_id", "n_chars", "edited_sha256", F.array_join("own", "").alias("fingerprint"),
        F.array_join("edit", "").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"))
