"""Near duplicates: MinHash with tensored banding, then links confirmed on whole shingle sets.

Equal sets are one class. Two collections of half keys, each half key a few MinHashes, are combined pair by
pair: ``s`` half keys of either side give ``s * s`` table keys from ``2 * s`` half keys' hashes, where plain
banding would need a hash group per table. Only half keys that several sets have are combined.

No bucket is expanded into all its pairs. Every bucket's members are confirmed against its hub, the member
with the largest buckets overall. What remains are members of one bucket that ended in different components;
they are joined exactly on their rarest shingles: two sets that are similar enough share one of the first few
in any common order, and the order by frequency leaves almost nothing to compare.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbcast.llm.common import hashed_words, mixed, sized, stored, texts_of
from kerbcast.llm.links import components

WORDS, PERCENT = 5, 80
#: MinHashes of a half key, and the share of pairs at the limit that one side of half keys may miss.
HALF_KEY, MISSED = 3, 5e-4
#: Bands of set sizes within the ratio that two similar sets can have.
SIZE_BANDS = 4
SEED = 23
#: Bits of a bitmap as Spark makes them, bits for each id that is looked up, and bitmaps that are broadcast at most.
BITMAP_BITS, BITS_AN_ID, MOST_BITMAPS = 32_768, 16, 1_024


def sides(percent: int, half_key: int = HALF_KEY, missed: float = MISSED) -> int:
    """Half keys per side: the fewest that miss at most ``missed`` of the pairs exactly at the limit."""
    return ceil(log(missed) / log(1 - (percent / 100) ** half_key))


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts (64-bit numbers, ascending within a text) and their numbers. A text
    with fewer words has its whole sequence as one shingle; without words the set is empty."""
    flat, counts = hashed_words(texts)
    shingles = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    start = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.empty(0, np.int64)
    of = np.repeat(np.arange(len(texts)), shingles)
    at = np.arange(len(of)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + start[of]
    span = np.minimum(counts, words)[of]
    value = np.zeros(len(of), dtype=np.uint64)
    for k in range(words):
        inside = span > k
        following = flat[np.minimum(at + k, max(0, len(flat) - 1))] if len(flat) else value
        value = np.where(inside, mixed(value + following + np.uint64(k + 1)), value)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    keep = np.r_[True, (value[1:] != value[:-1]) | (of[1:] != of[:-1])] if len(of) else np.empty(0, bool)
    return value[keep], np.bincount(of[keep], minlength=len(texts))


def half_keys(shingles: np.ndarray, sizes: np.ndarray, side: int, half_key: int) -> np.ndarray:
    """[texts with shingles, 2 * side] numbers, each made of ``half_key`` MinHashes."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 63, size=2 * side * half_key, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flips = rng.integers(0, 1 << 63, size=2 * side * half_key, dtype=np.uint64)
    start = np.concatenate([[0], np.cumsum(sizes[sizes > 0])[:-1]]).astype(np.int64)
    out = np.zeros((len(start), 2 * side), dtype=np.uint64)
    for i in range(2 * side * half_key):
        least = np.minimum.reduceat((shingles ^ flips[i]) * factors[i], start)
        out[:, i // half_key] = mixed(out[:, i // half_key] + least)
    return out


def signed(docs: DataFrame, words: int, side: int, half_key: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, two numbers that name the set, the half keys of every text, and ``anonym``, the
    digest that stands for a row without ``doc_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches):
            shingles, sizes = shingle_sets(batch.column("text").to_pylist(), words)
            has = sizes > 0
            names = np.zeros((2, len(sizes)), dtype=np.uint64)
            keys: list = [None] * len(sizes)
            if has.any():
                start = np.concatenate([[0], np.cumsum(sizes[has])[:-1]]).astype(np.int64)
                for row, salt in enumerate((1, 2)):
                    names[row, has] = np.add.reduceat(mixed(shingles * np.uint64(2 * salt + 1) + np.uint64(salt)), start)
                found = half_keys(shingles, sizes, side, half_key).view(np.int64)
                for i, k in zip(np.flatnonzero(has).tolist(), found.tolist()):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), *[pa.array(n.view(np.int64)) for n in names],
                 pa.array(keys, pa.list_(pa.int64())), batch.column("anonym")],
                ["doc_id", "n_shingles", "name1", "name2", "half_keys", "anonym"])

    return texts_of(docs).withColumn("anonym", anonym(F.col("doc_id"), F.col("text"))).mapInArrow(
        run, "doc_id long, n_shingles long, name1 long, name2 long, half_keys array<long>, anonym string")


def anonym(doc_id: F.Column, text: F.Column) -> F.Column:
    """What stands for a row without id: the digest of its text; null for all others."""
    return F.when(doc_id.isNull(), F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those ``pairs`` (``a``, ``b``) whose whole sets are similar enough, by the texts of both."""
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    full = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, "text_a"):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n = part.num_rows
                # Rows of one hub come together: equal texts of a batch are cut into shingles once.
                texts_here = part.column("text_a").to_pylist() + part.column("text_b").to_pylist()
                place = {t: i for i, t in enumerate(dict.fromkeys(texts_here))}
                values, sizes = shingle_sets(list(place), words)
                ends = np.cumsum(sizes)
                sets = [values[e - s:e] for e, s in zip(ends.tolist(), sizes.tolist())]
                linked = []
                for x, y in zip(texts_here[:n], texts_here[n:]):
                    one, two = sets[place[x]], sets[place[y]]
                    shared = len(one) + len(two) - len(np.union1d(one, two))
                    linked.append(100 * shared >= percent * (len(one) + len(two) - shared) and shared > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return full.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def possible(n: F.Column, m: F.Column, percent: int) -> F.Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def prefixes(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``shingle``, ``node``, ``component``, ``n``, ``place`` of the rarest shingles of each member: enough of
    them that two similar sets share one. Frequencies count within the members; ties go by the number itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches):
            values, sizes = shingle_sets(batch.column("text").to_pylist(), words)
            of = np.repeat(np.arange(len(sizes)), sizes)
            node, n = np.array(batch.column("node").to_pylist(), dtype=np.int64), sizes[of]
            for at in range(0, len(values), 100_000):
                cut = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[cut].view(np.int64)), pa.array(node[of[cut]]), pa.array(n[cut].astype(np.int64))],
                    ["shingle", "node", "n"])

    rows = stored(members.join(texts.withColumnRenamed("doc_id", "node"), "node").select("node", "text").mapInArrow(
        run, "shingle long, node long, n long"), "member_shingles")
    # A shingle that only one member has finds nothing; it matters only for the places of the others.
    frequency = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("frequency")).where("frequency > 1")
    place = F.row_number().over(Window.partitionBy("node").orderBy("frequency", "shingle"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("node"))
    placed = rows.join(frequency, "shingle").withColumn("place", place + F.col("n") - shared)
    needed = F.ceil(F.col("n") * percent / F.lit(100))
    return placed.where(F.col("place") <= F.col("n") - needed + 1).join(members, "node").select(
        "shingle", "node", "component", "n", "place")


def rest_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """Pairs of members in different components that can still be similar enough: they share a shingle of both
    prefixes, and neither their sizes nor what follows that shingle's places rules them out.

    The smaller set of such a pair has the shingle so early that what follows could be all the pair needs of two
    sets of that size; other rows can only be the larger one. That, and bands of sizes in the join's key, keep a
    crowd that shares a late shingle from being paired at all.
    """
    main = prefix.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("shingle").agg(
        F.max(F.struct("m", "component")).alias("best"), F.count(F.lit(1)).alias("k")).where("k > 1")
    width = max(log(100 / percent), 0.01) / SIZE_BANDS

    def band(n: F.Column) -> F.Column:
        return F.floor(F.ln(n.cast("double")) / F.lit(width))

    follow = F.col("n") - F.col("place") + 1
    # Written, so that the joins that follow have plain sides, whose large keys Spark can split.
    rows = stored(prefix.join(main.select("shingle", F.col("best.component").alias("main")), "shingle").select(
        "shingle", "node", "component", "n", "place", (F.col("component") != F.col("main")).alias("aside"),
        band(F.col("n")).alias("band"), (follow * (100 + percent) >= 2 * percent * F.col("n")).alias("early")), "shared_shingles")
    most = F.least(F.col("n") * 100, follow * (100 + percent) - percent * F.col("n"))
    smaller = rows.where("early").select(
        "shingle", "aside", F.explode(F.sequence(F.col("band"), band(F.floor(most / percent) + 1))).alias("band"),
        *[F.col(c).alias(f"{c}_a") for c in ("node", "component", "n", "place")])
    larger = rows.drop("aside", "early")
    shared = 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n") - F.col("place"))

    def met(some: DataFrame, others: DataFrame) -> DataFrame:
        return (some.drop("aside").join(others, ["shingle", "band"])
                .where((F.struct("n_a", "node_a") < F.struct("n", "node")) & (F.col("component_a") != F.col("component"))
                       & possible(F.col("n_a"), F.col("n"), percent)
                       & (shared * (100 + percent) >= percent * (F.col("n_a") + F.col("n"))))
                .select(F.least("node", "node_a").alias("a"), F.greatest("node", "node_a").alias("b")))

    aside = rows.where("aside").drop("aside", "early")
    return met(smaller.where("aside"), larger).unionByName(met(smaller.where("NOT aside"), aside)).distinct()


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, half_key: int = HALF_KEY,
                missed: float = MISSED) -> DataFrame:
    """The group of similar documents each document belongs to.

    ``docs``: ``doc_id``, ``text``; other columns are ignored. Documents are linked if ``100 * shared >=
    percent * united`` for their sets of ``words``-word shingles; a group is what links reach. Result, one row
    per input row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest ``doc_id`` of the group), ``kept``
    (``doc_id = component_id``). Null and empty texts have no shingles and are groups of their own. Repeated
    rows are in one group; rows that share a ``doc_id`` count as one document. A row without ``doc_id`` joins
    the group of rows with the same set, and is a group of its own (null) if no such row has an id. An empty
    table gives an empty result.
    """
    return _grouped(docs, words, percent, half_key, missed).select(
        "doc_id", "n_shingles", F.col("group").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("group")).alias("kept"))


def shared_halves(classes: DataFrame, side: int) -> DataFrame:
    """``node``, ``n``, ``lefts``, ``rights``: the half keys of either side that another class has too.

    A table key is shared only if both its half keys are, so no others need be combined.
    """
    halves = classes.select("node", "n", "name1", F.posexplode("half_keys").alias("i", "half")).select(
        "node", "n", "name1", (F.col("i") < side).alias("left"), F.xxhash64("i", "half").alias("half"))
    # Most occur once: they are dealt first and counted then, as counts before the shuffle would only fill memory.
    common = halves.select("half").repartition("half").groupBy("half").agg(
        F.count(F.lit(1)).alias("m")).where("m > 1").select("half")
    return halves.join(common, "half").groupBy("node", "n", "name1").agg(
        F.collect_list(F.when(F.col("left"), F.col("half"))).alias("lefts"),
        F.collect_list(F.when(~F.col("left"), F.col("half"))).alias("rights")).drop("name1")


def _grouped(docs: DataFrame, words: int, percent: int, half_key: int = HALF_KEY, missed: float = MISSED) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``name1``, ``name2``, ``anonym`` and ``group`` of every row."""
    side = sides(percent, half_key, missed)
    rows = stored(signed(docs, words, side, half_key), "signatures")
    name = ["name1", "name2"]
    classes = stored(rows.where("n_shingles > 0").groupBy(*name).agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("half_keys").alias("half_keys")), "classes")

    tables = (stored(shared_halves(classes.where("node IS NOT NULL"), side), "shared_halves")
              .select("node", "n", F.explode("lefts").alias("left"), "rights")
              .select("node", "n", "left", F.explode("rights").alias("right"))
              .select(F.xxhash64("left", "right").alias("key"), "node", "n"))
    sizes = tables.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    buckets = stored(tables.join(sizes, "key"), "buckets")
    central = buckets.groupBy("node").agg(F.sum("m").alias("central"))
    ranked = stored(buckets.join(central, "node"), "ranked")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("central", (-F.col("node")).alias("minus"), "n")).alias("hub"))
    member_of = ranked.join(hubs, "key")
    hub = -F.col("hub.minus")
    pairs = member_of.where((F.col("node") != hub) & possible(F.col("n"), F.col("hub.n"), percent)).select(
        F.col("node").alias("a"), hub.alias("b")).distinct()

    nodes = stored(ranked.select(F.col("node").alias("doc_id")).distinct(), "candidates")
    texts = stored(texts_of(docs).join(nodes, "doc_id", "left_semi"), "candidate_texts")
    links = stored(confirmed(pairs, texts, words, percent), "links")
    found = components(links)

    # Members of one bucket, other than its hub, in different components: not yet compared with each other.
    placed = member_of.where(F.col("node") != hub).join(found, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    members = stored(placed.join(open_keys.select("key"), "key", "left_semi").select("node", "component").distinct(), "members")
    prefix = stored(prefixes(members, texts, words, percent), "prefixes")
    more = stored(confirmed(rest_pairs(prefix, percent), texts, words, percent), "more_links")
    if more.limit(1).count():
        found = components(links.union(more))

    grouped = classes.join(found, "node", "left").select(*name, F.coalesce("component", "node").alias("group"))
    plain = rows.select("doc_id", "n_shingles", *name, "anonym")
    return plain.where("n_shingles > 0").join(grouped, name).unionByName(
        plain.where("n_shingles = 0").withColumn("group", F.col("doc_id")))


def marked_by_bitmaps(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with ``asked``: whether ``doc_id`` can be among ``ids``, by bitmaps of their hashes. It is true for all
    that are, and for about one in ``BITS_AN_ID`` of the others, more if ``MOST_BITMAPS`` are too few."""
    bitmaps = min(MOST_BITMAPS, max(1, -(-ids.count() * BITS_AN_ID // BITMAP_BITS)))
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(bitmaps * BITMAP_BITS))
    number, bit = F.shiftright(place, 15).alias("number"), place.bitwiseAND(BITMAP_BITS - 1).alias("bit")
    made = ids.select(number, bit).groupBy("number").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    byte = F.conv(F.hex(F.substr("bitmap", (F.shiftright("bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    asked = F.getbit(byte, F.col("bit").bitwiseAND(7).cast("int")) == 1
    return rows.select("*", number, bit).join(F.broadcast(made), "number", "left").withColumn(
        "asked", F.coalesce(asked, F.lit(False))).drop("number", "bit", "bitmap")


def without_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``doc_id`` is not among ``ids``. Only rows that the bitmaps cannot rule out are looked up, so
    that the texts of all others stay where they lie."""
    marked = marked_by_bitmaps(rows, ids)
    looked_up = marked.where("asked").join(ids, "doc_id", "left_anti")
    return marked.where("NOT asked").unionByName(looked_up).drop("asked")


def without_near_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with all its columns and one document of each group, the one with the smallest ``doc_id``.

    A row without ``doc_id`` goes if a row with the same set has one; of rows without ``doc_id`` whose sets are equal
    one stays, and those without a shingle all stay.
    """
    groups = _grouped(docs, words, percent)
    dropped = stored(groups.where("doc_id IS NOT NULL AND doc_id <> group").select("doc_id").distinct(), "dropped")
    named = docs.where(F.col("doc_id").isNotNull())
    rows = named.select(F.col("doc_id").cast("long").alias("doc_id"), _entry(docs))
    kept = without_ids(rows, dropped).select("entry.*")
    nameless = groups.where("anonym IS NOT NULL")
    if not nameless.limit(1).count():
        return kept
    alone = nameless.where("n_shingles > 0 AND group IS NULL").groupBy("name1", "name2").agg(F.min("anonym").alias("mark"))
    mark = anonym(F.col("doc_id"), F.col("text"))
    others = docs.where(F.col("doc_id").isNull()).select(mark.alias("mark"), _entry(docs))
    once = others.join(alone.select("mark"), "mark", "left_semi").dropDuplicates(["mark"])
    empty = nameless.where("n_shingles = 0").select(F.col("anonym").alias("mark")).distinct()
    return kept.unionByName(once.select("entry.*")).unionByName(
        others.join(empty, "mark", "left_semi").select("entry.*"))


def _entry(docs: DataFrame) -> F.Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("entry")
