"""Source divergence audit: which sources of a language, and which terms, differ most in their term shares.

A first pass counts in how many documents of its language each term occurs; terms at or above the limit are kept,
exactly. They are numbered by minimal perfect hashes, one per shard of a bounded number of terms, built in parallel:
levels of bits, in which a term that falls on a bit alone takes it, the others going on to the next level. A second
pass looks every term up, compares it with the term stored at its number, and adds to dense slots per group. The
hashes of the most frequent terms, bounded in number and in bytes, are broadcast for it; what is not found there is
counted by an ordinary shuffle and joined with the other kept terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbcast.llm.common import mixed, sized, stored

#: For each byte of UTF-8: ASCII letters (A-Z in lower case) and everything beyond ASCII stay, others part terms.
LETTERS = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))
#: Terms of all languages that are counted by broadcast hashes, and the bytes of the longest of them: 64 MB at most.
BROADCAST_TERMS, BROADCAST_BYTES = 1_000_000, 64
#: Terms a shard has on average; a language's shards rise with its terms.
SHARD_TERMS = 4096
#: Terms a task remembers, and counts (of 4 bytes) it holds before it hands them on.
HELD_TERMS, HELD_SLOTS = 400_000, 16_000_000
SCALE = 1_000_000_000
#: Numbers in one dense block of sources and terms.
BLOCK_CELLS = 1 << 17


# --- perfect hashes ----------------------------------------------------------------------------------------------

def hashes(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit numbers per term (an object array of strings)."""
    return tuple(pd.util.hash_array(terms, hash_key=key, categorize=False)
                 for key in ("0123456789123456", "divergence_audit"))


def places(level: int, size: np.ndarray | int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        spread = mixed(first + np.uint64(level) * (second | np.uint64(1)))
    return (spread % np.asarray(size, dtype=np.uint64)).astype(np.int64)


def shard_of(first: np.ndarray, shards: int) -> np.ndarray:
    return ((first >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def built(terms: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The bits of each level, and the terms (an object array without repeats) in the order of their numbers.

    Terms whose two hashes are both equal never part; they stand behind the others and are found by comparison.
    """
    first, second = hashes(terms)
    open_, levels, order = np.arange(len(terms)), [], []
    while len(open_) and len(levels) < 64:
        size = 2 * len(open_)
        place = places(len(levels), size, first[open_], second[open_])
        bits = np.bincount(place, minlength=size) == 1
        alone = bits[place]
        levels.append(bits)
        order.append(open_[alone][np.argsort(place[alone])])
        open_ = open_[~alone]
    return levels, terms[np.concatenate([*order, open_])] if len(terms) else terms


class PerfectHash:
    """The perfect hashes of all shards of a language side by side: 0.6 bytes a term, and the stored terms."""

    def __init__(self, shards: list[tuple[list[np.ndarray], np.ndarray]]):
        self.shards = len(shards)
        #: First number of each shard; a term's number is that of its shard plus its place among its terms.
        self.starts = np.cumsum([0, *(len(terms) for _, terms in shards)])
        taken = self.starts[:-1].copy()
        self.sizes, self.offsets, self.words, self.ranks = [], [], [], []
        for level in range(max((len(levels) for levels, _ in shards), default=0)):
            bits = [levels[level] if level < len(levels) else np.zeros(0, dtype=bool) for levels, _ in shards]
            padded = [np.pad(b, (0, -len(b) % 64)) for b in bits]
            words = [np.packbits(b, bitorder="little").view(np.uint64) for b in padded]
            counts = [np.bitwise_count(w).astype(np.int64) for w in words]
            self.sizes.append(np.array([max(1, len(b)) for b in bits]))
            self.offsets.append(np.cumsum([0, *map(len, words)]))
            self.words.append(np.concatenate([*words, np.zeros(1, dtype=np.uint64)]))
            self.ranks.append(np.concatenate(
                [*(t + np.cumsum(c) - c for t, c in zip(taken, counts)), [0]]).astype(np.int32))
            taken += [int(c.sum()) for c in counts]
        self.terms = pa.array([t for _, terms in shards for t in terms], pa.large_string())
        self.left = {self.terms[n].as_py(): n for at, stop in zip(taken, self.starts[1:]) for n in range(at, stop)}

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term (an object array of strings), -1 for a term that is not stored."""
        out = np.full(len(terms), -1, dtype=np.int64)
        if not self.shards:
            return out
        first, second = hashes(terms)
        shard, open_ = shard_of(first, self.shards), np.arange(len(terms))
        for level, (sizes, offsets, words, ranks) in enumerate(
                zip(self.sizes, self.offsets, self.words, self.ranks)):
            mine = shard[open_]
            place = places(level, sizes[mine], first[open_], second[open_])
            at, bit = offsets[mine] + (place >> 6), (place & 63).astype(np.uint64)
            at[offsets[mine] == offsets[mine + 1]] = len(words) - 1
            word = words[at]
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[here]] = ranks[at[here]] + below[here]
            open_ = open_[~here]
        if self.left:
            out[open_] = [self.left.get(terms[i], -1) for i in open_]
        found = np.flatnonzero(out >= 0)
        same = pc.equal(self.terms.take(pa.array(out[found])), pa.array(terms[found], pa.large_string()))
        out[found[~same.to_numpy(zero_copy_only=False)]] = -1
        return out


# --- passes over the texts ---------------------------------------------------------------------------------------

def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(LETTERS).split()


def _columns(batch: pa.RecordBatch) -> zip:
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, docs) of a task, handed on whenever there are many."""
    counts: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array([t.decode() for t in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())],
                ["lang", "term", "docs"])
        counts.clear()

    for batch in sized(batches):
        for lang, text in _columns(batch):
            counts.setdefault(lang, Counter()).update(set(terms_of(text)))
        if sum(map(len, counts.values())) > HELD_TERMS:
            yield from out()
    yield from out()


CELLS = "slot long, lang string, source string, term string, n long"


def _cells(slots, lang: str | None, source: str | None, terms, counts) -> pa.RecordBatch:
    """Counts of broadcast terms by slot alone, or of other terms by themselves."""
    n = len(counts)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()) if slots is None else pa.array(slots, pa.int64()),
         *(pa.nulls(n, pa.string()) if x is None else pa.array(x, pa.string())
           for x in (None if lang is None else [lang] * n, None if source is None else [source] * n, terms)),
         pa.array(counts, pa.int64())], ["slot", "lang", "source", "term", "n"])


class Recount:
    """The second pass over the texts of one task.

    Counts lie in dense slots per group, one per broadcast term and one more for all other terms; of languages whose
    kept terms are not all broadcast, those others are counted by themselves. A slot is handed on as one number: the
    group's place in ``groups``, and 32 bits for the term's number.
    """

    def __init__(self, shared: dict[str, PerfectHash], complete: set[str], groups: list[tuple[str, str]]):
        self.shared, self.complete = shared, complete
        self.place = {group: i for i, group in enumerate(groups)}
        self.known: dict[str, dict[bytes, int]] = {}
        self.slots: dict[tuple[str, str], np.ndarray] = {}
        self.others: dict[tuple[str, str], Counter] = {}

    def numbers(self, lang: str, terms: list[bytes]) -> np.ndarray:
        """The slot of each term; a term new to the task is looked up by its perfect hash once."""
        table = self.shared[lang]
        known = self.known.setdefault(lang, {})
        fresh = list(set(terms).difference(known))
        if fresh:
            found = table.numbers(np.array([t.decode() for t in fresh], dtype=object))
            known.update(zip(fresh, np.where(found < 0, len(table.terms), found).tolist()))
        return np.fromiter(map(known.__getitem__, terms), dtype=np.int64, count=len(terms))

    def add(self, lang: str, source: str, terms: list[bytes]) -> None:
        if lang in self.shared:
            width = len(self.shared[lang].terms) + 1
            numbers = self.numbers(lang, terms)
            if (lang, source) not in self.slots:
                self.slots[lang, source] = np.zeros(width, dtype=np.int32)
            np.add.at(self.slots[lang, source], numbers, 1)
            if lang in self.complete:
                return
            terms = [terms[i] for i in np.flatnonzero(numbers == width - 1)]
            if not terms:
                return
        elif lang in self.complete:
            return
        self.others.setdefault((lang, source), Counter()).update(terms)

    @property
    def full(self) -> bool:
        return (sum(map(len, self.slots.values())) > HELD_SLOTS or sum(map(len, self.others.values())) > HELD_TERMS)

    def forget(self) -> None:
        if sum(map(len, self.known.values())) > HELD_TERMS:
            self.known.clear()

    def out(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in self.slots.items():
            numbers = np.flatnonzero(counts[:-1])
            yield _cells((self.place[lang, source] << 32) + numbers, None, None, None, counts[numbers])
        for (lang, source), counts in self.others.items():
            yield _cells(None, lang, source, [t.decode() for t in counts], list(counts.values()))
        self.slots.clear()
        self.others.clear()


def _recounted(
    shared: dict[str, PerfectHash], complete: set[str], groups: list[tuple[str, str]], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    task = Recount(shared, complete, groups)
    for batch in sized(batches, size=8_000_000):
        found: dict[tuple[str, str], list[bytes]] = {}
        for lang, source, text in _columns(batch):
            found.setdefault((lang, source), []).extend(terms_of(text))
        for (lang, source), terms in found.items():
            task.add(lang, source, terms)
        task.forget()
        if task.full:
            yield from task.out()
    yield from task.out()


# --- exact shares ------------------------------------------------------------------------------------------------

def shares(counts: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """1 + floor(10 ** 9 * (count + 1) / whole), in three steps of 10 ** 3, so that no product leaves 64 bits."""
    rest, out = counts + 1, np.zeros_like(counts)
    whole = np.maximum(whole, 1)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


# --- the audit ---------------------------------------------------------------------------------------------------

def kept_terms(rows: DataFrame, least: int) -> DataFrame:
    """(lang, term, docs) of the terms in at least ``least`` documents of their language."""
    parts = rows.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, docs long")
    return parts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)


def _marked(kept: DataFrame) -> DataFrame:
    """(lang, term, shared): shared are the short terms in at least so many documents that no more than the limit are."""
    short = F.octet_length("term") <= BROADCAST_BYTES
    found = (
        kept.where(short).groupBy("docs").agg(F.count(F.lit(1)).alias("n"))
        .select("docs", F.sum("n").over(Window.orderBy(F.desc("docs"))).alias("terms"))
        .where(F.col("terms") <= BROADCAST_TERMS).agg(F.min("docs").alias("docs")).first()["docs"])
    shared = F.lit(False) if found is None else short & (F.col("docs") >= found)
    return kept.select("lang", "term", shared.alias("shared"))


def _hashed_shards(marked: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(lang, shard, levels, terms) of the shared terms, each shard built in a task of its own."""
    shards = {lang: max(1, -(-n // SHARD_TERMS)) for lang, n in sizes.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first, _ = hashes(batch["term"].to_numpy(dtype=object))
            width = batch["lang"].map(shards).to_numpy().astype(np.uint64)
            yield batch.assign(shard=((first >> np.uint64(32)) % width).astype(np.int32))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        levels, terms = built(group["term"].to_numpy(dtype=object))
        row = (key[0], key[1], [np.packbits(b).tobytes() for b in levels], [len(b) for b in levels], list(terms))
        return pd.DataFrame([row], columns=["lang", "shard", "levels", "sizes", "terms"])

    placed = marked.where("shared").select("lang", "term").mapInPandas(place, "lang string, term string, shard int")
    return placed.groupBy("lang", "shard").applyInPandas(
        build, "lang string, shard int, levels array<binary>, sizes array<int>, terms array<string>")


def _tables(hashed: DataFrame, sizes: dict[str, int]) -> dict[str, PerfectHash]:
    """The hashes to broadcast, at most ``BROADCAST_TERMS`` terms of ``BROADCAST_BYTES`` each."""
    nothing = ([], np.empty(0, dtype=object))
    parts = {lang: [nothing] * max(1, -(-n // SHARD_TERMS)) for lang, n in sizes.items() if n}
    for row in hashed.toLocalIterator():
        levels = [np.unpackbits(np.frombuffer(bytes(b), dtype=np.uint8), count=n).astype(bool)
                  for b, n in zip(row["levels"], row["sizes"])]
        parts[row["lang"]][row["shard"]] = (levels, np.array(row["terms"], dtype=object))
    return {lang: PerfectHash(shards) for lang, shards in parts.items()}


def audit(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """Divergence of the sources of each language from one another, and of their terms from the language.

    ``docs``: ``lang``, ``source``, ``text`` (null: empty); other columns are ignored; every row is a document. Kept
    terms are those in ``least`` documents of their language. With the count of a kept term in a group, N all of the
    group's and V kept terms, its share is p = 1 + floor(10**9 * (count + 1) / (N + V)). Result: ``lang``, ``source``,
    ``part``, ``item``, ``value``, ``rank``. Part ``pair``: for each other source of the language, the sum over all
    kept terms of floor((p - q)**2 / q), q being its share. Part ``term``: the terms that occur in the group with
    p above the language's share q, by the same measure, up to rank ``top``. Of equal values the item that comes first
    in code points ranks first. A group without kept terms has shares of 1/V; a language without kept terms has
    pairs of value 0. An empty table gives an empty result.

    To the driver come one number per (lang, source), whose pairs are rows of the result, and the broadcast terms.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = sorted((r["lang"], r["source"]) for r in rows.select("lang", "source").distinct().collect())
    kept = stored(kept_terms(rows, least), "kept_terms")
    sizes = {r["lang"]: r["n"] for r in kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    marked = stored(_marked(kept), "marked_terms")
    shared = {r["lang"]: r["n"] for r in marked.where("shared").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    hashed = stored(_hashed_shards(marked, shared), "perfect_hashes")
    tables = _tables(hashed, shared)
    complete = {lang for lang, _ in groups if shared.get(lang, 0) == sizes.get(lang, 0)}
    cells = stored(_all_counts(rows, marked, hashed, tables, complete, groups), "term_counts")
    totals = {(r["lang"], r["source"]): r["n"]
              for r in cells.groupBy("lang", "source").agg(F.sum("n").alias("n")).collect()}
    found = _measured(cells, groups, totals, sizes, top)
    flat = [(lang, s, t, 0) for lang, s in groups if lang not in sizes for other, t in groups if other == lang and t != s]
    nothing = spark.createDataFrame(flat, "lang string, source string, item string, value long")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    each = pairs.unionByName(nothing).withColumn("part", F.lit("pair")).unionByName(found.where("part = 'term'"))
    ranked = each.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return ranked.where((F.col("rank") <= top) | (F.col("part") == "pair")).select(
        "lang", "source", "part", "item", "value", "rank")


def _all_counts(
    rows: DataFrame, marked: DataFrame, hashed: DataFrame, tables: dict[str, PerfectHash], complete: set[str],
    groups: list[tuple[str, str]],
) -> DataFrame:
    """(lang, source, term, n) of all kept terms: slots by their number, the others by the term itself."""
    shared = rows.sparkSession.sparkContext.broadcast(tables)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _recounted(shared.value, complete, groups, batches)

    cells = rows.select("lang", "source", "text").mapInArrow(count, CELLS)
    whole = complete.issuperset(r["lang"] for r in marked.select("lang").distinct().collect())
    if not whole:
        # Written, so that the texts are read once for both kinds of cells.
        cells = stored(cells, "cells")
    # One long is the key that Spark adds up fastest; names and terms come to the sums.
    slots = cells.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("n").alias("n")).select(
        F.shiftright("slot", 32).alias("place"), F.col("slot").bitwiseAND((1 << 32) - 1).alias("number"), "n")
    names = rows.sparkSession.createDataFrame([(i, *group) for i, group in enumerate(groups)], "place long, lang string, source string")
    found = slots.join(F.broadcast(names), "place").join(_numbered(hashed), ["lang", "number"]).select("lang", "source", "term", "n")
    if whole:
        return found
    others = cells.where("slot IS NULL").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    rare = marked.where("NOT shared").select("lang", "term")
    return found.unionByName(others.join(rare, ["lang", "term"]).select("lang", "source", "term", "n"))


def _numbered(hashed: DataFrame) -> DataFrame:
    """(lang, number, term) of the broadcast terms; the window runs over one row per shard."""
    before = Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.size("terms")).over(before), F.lit(0))
    return hashed.withColumn("start", start).select(
        "lang", "start", F.posexplode("terms").alias("place", "term")).select(
        "lang", (F.col("start") + F.col("place")).alias("number"), "term")


def _measured(
    cells: DataFrame, groups: list[tuple[str, str]], totals: dict[tuple[str, str], int], sizes: dict[str, int], top: int
) -> DataFrame:
    """(lang, source, item, value, part): sums of a block of terms for each pair, and the block's best terms.

    A block holds few enough terms for a dense table of all sources of the language; every kept term is in one.
    """
    sources: dict[str, list[str]] = {}
    for lang, source in groups:
        sources.setdefault(lang, []).append(source)
    # In order of their names, so that equal values are ranked by position.
    width = {lang: max(1, BLOCK_CELLS // len(sources[lang])) for lang in sizes}
    blocks = F.create_map(*[F.lit(x) for lang in sizes for x in (lang, -(-sizes[lang] // width[lang]))]) if sizes else None
    block = F.pmod(F.xxhash64("term"), blocks[F.col("lang")]) if sizes else F.lit(0).cast("long")

    def measure(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        lang = key[0]
        names, size = sources[lang], sizes[lang]
        row = {s: i for i, s in enumerate(names)}
        spot, terms = pd.factorize(group["term"].to_numpy(dtype=object), sort=True)
        counts = np.zeros((len(names), len(terms)), dtype=np.int64)
        counts[group["source"].map(row).to_numpy(), spot] = group["n"].to_numpy()
        n = np.array([totals.get((lang, s), 0) for s in names], dtype=np.int64)
        p = shares(counts, (n + size)[:, None])
        whole = shares(counts.sum(axis=0), int(n.sum()) + size)
        out = []
        for i, source in enumerate(names):
            sums = gaps(p[i], p).sum(axis=1)
            out.append(pd.DataFrame({"source": source, "item": names, "value": sums, "part": "pair"}).drop(index=i))
            above = np.flatnonzero((counts[i] > 0) & (p[i] > whole))
            value = gaps(p[i, above], whole[above])
            best = np.argsort(-value, kind="stable")[:top]
            out.append(pd.DataFrame(
                {"source": source, "item": terms[above[best]], "value": value[best], "part": "term"}))
        return pd.concat(out).assign(lang=lang)[["lang", "source", "item", "value", "part"]]

    return cells.withColumn("block", block).groupBy("lang", "block").applyInPandas(
        measure, "lang string, source string, item string, value long, part string")
