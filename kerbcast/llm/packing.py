"""Packing documents into sequences of a fixed number of tokens, improved by swap-based local search.

Documents are tokenised once and cut only where longer than a sequence. Pieces are dealt into blocks of
bounded size by a hash of their identity; every block is packed on its own: best fit by decreasing length,
then local search between underfull bins (moves, one-for-one and two-for-one exchanges that raise the sum of
squared fills), which empties bins, until the bound of the block is met or nothing helps any more.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import slices, stored, texts_of

MAX_TOKENS = 2048
END_ID = 0
#: Pieces packed together; a block's loss is at most a few sequences in thousands.
BLOCK_PIECES = 16_384
#: Words remembered by one Python worker; emptied when full, which changes no result.
REMEMBERED = 600_000

_TOKENIZERS: dict[str, "WordTokens"] = {}


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters stand
    for themselves, the other bytes for the characters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordTokens(dict):
    """The ids (little-endian 32-bit) of words between ASCII white space, as the tokenizer gives them.

    Its normalisation and splitting drop white space and never look across it, so a text's ids are those of
    its words in order. Most words are Latin letters with punctuation behind; those two parts are split, lower
    case and composed as the tokenizer would have them, so its model takes them directly, and words that differ
    in case or punctuation share their letters' ids. Any other word takes the tokenizer's whole way. Tests
    compare both.
    """

    #: Letters that lower-case one to one and have no other composed form; then ASCII punctuation.
    SIMPLE = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.parts: dict[str, bytes] = {"": b""}

    def part(self, s: str) -> bytes:
        """Ids of one run of letters or of punctuation."""
        found = self.parts.get(s)
        if found is None:
            mapped = s if s.isascii() else "".join([self.letters[b] for b in s.encode("utf-8")])
            ids = [t.id for t in self.tokenizer.model.tokenize(mapped)]
            found = self.parts[s] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def learn(self, words: set[bytes]) -> None:
        if len(self) > REMEMBERED:
            self.clear()
        if len(self.parts) > REMEMBERED // 2:
            self.parts = {"": b""}
        other = []
        for w in words:
            if w not in self:
                simple = self.SIMPLE.fullmatch(w.decode("utf-8"))
                if simple:
                    self[w] = self.part(simple[1].lower()) + self.part(simple[2])
                else:
                    other.append(w)
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in other], add_special_tokens=False)
        for w, e in zip(other, encoded):
            self[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)


def tokens_at(path: str) -> WordTokens:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokens(path)
    return _TOKENIZERS[path]


def pieces_of(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Pieces of every whole document: its ids, then the end id, cut every ``max_tokens``."""
    end, width = np.array([END_ID], dtype="<u4").tobytes(), 4 * max_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_ids = tokens_at(tokenizer_path)
        for batch in slices(batches):
            split = [t.encode("utf-8").split() for t in batch.column("text").to_pylist()]
            words_ids.learn({w for x in split for w in x})
            doc, piece, start, length, crc = [], [], [], [], []
            for doc_id, words in zip(batch.column("doc_id").to_pylist(), split):
                ids = b"".join([*[words_ids[w] for w in words], end])
                for n, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    doc.append(doc_id)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts_of(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Bins of one block: the lengths and items in each, and an ordered index of free space."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.free: list[tuple[int, int]] = []

    def add(self, item: int, length: int) -> None:
        """Best fit: the bin with the least room that still holds the item, else a new one."""
        at = bisect_left(self.free, (length, -1))
        if at < len(self.free):
            room, b = self.free.pop(at)
            self.items[b].append(item)
            self.fill[b] += length
        else:
            b, room = len(self.items), self.capacity
            self.items.append([item])
            self.fill.append(length)
        if room > length:
            insort(self.free, (room - length, b))

    def refill(self, b: int, items: list[int], fill: int) -> None:
        """Replace what lies in a bin and keep the index right; a full or empty bin leaves it."""
        room = self.capacity - self.fill[b]
        if self.fill[b] and room:
            self.free.pop(bisect_left(self.free, (room, b)))
        self.items[b], self.fill[b] = items, fill
        if fill and fill < self.capacity:
            insort(self.free, (self.capacity - fill, b))


def fewest_bins(length: list[int], capacity: int) -> int:
    """A lower bound of bins: the sum of lengths, pieces above one half with what fits beside none of them, and
    pieces weighed in steps of 1/k (of pieces above one third, for example, no bin holds three)."""
    if not length:
        return 0
    x = np.sort(np.array(length, dtype=np.int64))
    upto = np.r_[0, np.cumsum(x)]
    large = len(x) - np.searchsorted(x, capacity // 2, side="right")
    best = max(1, -(-int(upto[-1]) // capacity), large)
    for least in np.unique(x[x <= capacity // 2]).tolist():
        # Pieces from ``least`` on, beside which those longer than the rest of a bin take no place for them.
        low, high = np.searchsorted(x, least), np.searchsorted(x, capacity - least, side="right")
        best = max(best, len(x) - int(high) + -(-int(upto[high] - upto[low]) // capacity))
    for k in range(2, 33):
        # Weights of 1/k, whole numbers here: (k + 1) x / capacity rounded down, exact where it divides.
        steps, rest = np.divmod((k + 1) * x, capacity)
        best = max(best, -(-int(np.where(rest == 0, steps * k, steps * (k + 1)).sum()) // (k * (k + 1))))
    return best


def sums_of(items: list[int], length: list[int], capacity: int) -> dict[int, tuple[int, ...]]:
    """Every sum of one or two different items up to the capacity, and items that give it, one if one does."""
    by_length: dict[int, list[int]] = {}
    for i in sorted(items):
        by_length.setdefault(length[i], []).append(i)
    found: dict[int, tuple[int, ...]] = {n: (i[0],) for n, i in by_length.items()}
    kinds = sorted(by_length)
    for at, small in enumerate(kinds):
        for other in kinds[at:]:
            if small + other > capacity:
                break
            if small != other:
                found.setdefault(small + other, (by_length[small][0], by_length[other][0]))
            elif len(by_length[small]) > 1:
                found.setdefault(small + other, tuple(by_length[small][:2]))
    return found


def improve(bins: Bins, length: list[int]) -> None:
    """Local search: the emptiest bin gives to the others what fits, then exchanges one or two of its items for
    a smaller one of a bin at least as full, each time where the sum of squared fills grows most. It ends at
    ``fewest_bins`` or when no bin finds a move or an exchange. The sum is a whole number and grows with every
    step, so the search ends without a limit on sweeps."""
    capacity, fewest = bins.capacity, fewest_bins(length, bins.capacity)
    used = sum(1 for f in bins.fill if f)
    size, home = np.array(length, dtype=np.int64), np.zeros(len(length), dtype=np.int64)
    reach = size.copy()  # an item's length and its bin's room: what may take its place

    def refill(b: int, items: list[int], fill: int) -> None:
        bins.refill(b, items, fill)
        reach[items], home[items] = size[items] + (capacity - fill), b

    for b, items in enumerate(bins.items):
        reach[items], home[items] = size[items] + (capacity - bins.fill[b]), b
    changed = True
    while changed:
        changed = False
        for _, source in sorted(bins.free, key=lambda x: (-x[0], x[1])):
            if used <= fewest:
                return
            if not bins.fill[source] or bins.fill[source] == capacity:
                continue
            for item in sorted(bins.items[source], key=lambda i: -length[i]):
                # Move: to the fullest bin with room for it, if that one is then fuller than the source was.
                at = bisect_left(bins.free, (length[item], -1))
                while at < len(bins.free) and bins.free[at][1] == source:
                    at += 1
                if at < len(bins.free) and bins.fill[bins.free[at][1]] + length[item] > bins.fill[source]:
                    target = bins.free[at][1]
                    refill(target, [*bins.items[target], item], bins.fill[target] + length[item])
                    refill(source, [i for i in bins.items[source] if i != item], bins.fill[source] - length[item])
                    changed = True
            if not bins.fill[source]:
                used -= 1
                continue
            while True:
                mine = bins.items[source]
                sums = sums_of(mine, length, capacity)
                # For every length the largest sum up to it; pieces of full bins and of the source gain nothing.
                largest = np.zeros(capacity + 1, dtype=np.int64)
                largest[list(sums)] = list(sums)
                largest = np.maximum.accumulate(largest)
                gain = largest.take(reach) - size
                gain[mine] = 0
                some = np.flatnonzero(gain > 0)
                gain = gain[some]
                ahead = capacity - (reach[some] - size[some]) - bins.fill[source]
                growth = np.where(ahead >= 0, gain * (ahead + gain), 0)
                best = int(np.argmax(growth)) if len(some) else 0
                if not len(some) or growth[best] <= 0:
                    break
                theirs, more = int(some[best]), int(gain[best])
                target, moved = int(home[theirs]), sums[length[theirs] + more]
                refill(target, [i for i in bins.items[target] if i != theirs] + list(moved), bins.fill[target] + more)
                refill(source, [i for i in mine if i not in moved] + [theirs], bins.fill[source] - more)
                changed = True


def packed_block(length: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin number and offset of each item: best fit decreasing, then local search."""
    bins = Bins(capacity)
    for item in sorted(range(len(length)), key=lambda i: (-length[i], i)):
        bins.add(item, length[item])
    improve(bins, length)
    number, offset, used = [0] * len(length), [0] * len(length), 0
    for items in bins.items:
        at = 0
        for item in items:
            number[item], offset[item] = used, at
            at += length[item]
        used += bool(items)
    return number, offset


def packed(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
           block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Sequences of at most ``max_tokens`` tokens that hold every token of every whole text once.

    ``docs``: ``doc_id``, ``text``; other columns are ignored. Result, one row per piece: ``doc_id``, ``piece``
    (from 0), ``start`` (ids of the document before it), ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.
    A null or empty text is one piece with the end id alone. Repeated rows are documents of their own, each
    packed. A null ``doc_id`` stays null. Ties in length go by the order of (doc_id as text, piece, ids_crc32).
    An empty table gives an empty result.
    """
    pieces = stored(pieces_of(docs, tokenizer_path, max_tokens), "pieces")
    blocks = max(1, -(-pieces.where(F.col("length") < max_tokens).count() // block_pieces))
    numbered = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    whole = F.col("length") == max_tokens
    # Ids travel as text: pandas has no whole numbers with nulls among them.
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable")
        number, offset = packed_block(group["length"].tolist(), max_tokens)
        # The low numbers of a block's range; whole pieces get negative numbers of their own.
        group["sequence_id"] = group["block"] * (1 << 32) + np.array(number, dtype=np.int64)
        group["offset"] = np.array(offset, dtype=np.int64)
        return group.drop(columns="block")

    named = numbered.where(~whole).withColumn("doc_id", F.col("doc_id").cast("string"))
    rest = named.groupBy("block").applyInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
    full = pieces.where(whole).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return rest.unionByName(full)
