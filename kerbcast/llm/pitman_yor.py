"""Scores of texts by a hierarchical Pitman-Yor model of words, with sampled seating arrangements.

Every context is a restaurant; its customers are the words that followed it in training, its dishes their
kinds, and every table sends one customer to the parent restaurant. A context is the whole preceding word or the start
of a text; its parent is the ending of that word (its last three bytes), shared by all words that end so; the parent of
every ending is one restaurant all share, whose own tables draw from a uniform base over the known words and one
unknown word. Every word and every ending that occurs has a restaurant of its own.

Seating is sampled by blocked Gibbs sweeps: all customers of one dish in a restaurant leave and are seated
anew, one after another as in a Chinese restaurant process (in growing groups beyond the 64th), given how many
tables the other dishes have there in the sweep before. Dishes are independent given these totals, so words
are dealt to buckets and every bucket samples on its own. Between sweeps only the totals of the restaurants are summed
up: those of endings, two values for each that occurs, on the driver; those of preceding words by a shuffle on the
word, as there are as many as words. The seating after each sweep is written. Predictive probabilities are averaged
over the sweeps after burn-in.

The corpus is tokenised once. A batch of texts asks for each of its pairs of words once, packed as sorted arrays by
bucket, and keeps which text has which pair how often; the answers come back to the batch. So a pair in very many texts
is one entry per batch. Pairs of very frequent words (chosen on a sample, which only decides where a word is handled)
are dealt by word and ending of the word before, as one bucket must not hold them; of the totals of such a word only its
place in the shared restaurant goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.llm.common import ascii_words, mixed, sized, texts_of
from kerbcast.llm.exact_copies import ascii_lower
from kerbcast.session import fresh_path, removed

#: Longest ending in bytes, and the numbers of all endings: by length, then by value (0: the start of a text).
ENDING = 3
FIRST = [sum(256 ** k for k in range(n)) for n in range(ENDING + 2)]
CONTEXTS = FIRST[-1]
#: Sweeps in all, and those left out of the average.
SWEEPS, BURN_IN = 4, 1
STRENGTH, SEED = 1.0, 5
#: Text tokenised together; text whose words one bucket holds, and the least number of buckets; most words
#: handled apart.
BATCH_BYTES, BUCKET_BYTES, LEAST_BUCKETS, HEAVY_WORDS = 4_000_000, 16_000_000, 8, 1024
#: Customers of a dish seated one by one; later ones in groups of an eighth of those seated.
ONE_BY_ONE = 64
END = b""
CODEC = "zstd"


def put(a: np.ndarray) -> bytes:
    """An array of non-negative integers or floats, compressed; integers take the smallest width."""
    if a.dtype.kind in "iu":
        top = int(a.max()) if len(a) else 0
        kind = next(k for k in ("u1", "u2", "u4", "u8") if top <= np.iinfo(k).max)
        a = a.astype(kind)
    raw = a.tobytes()
    return f"{a.dtype.str[1:]}{len(raw):012d}".encode() + pa.Codec(CODEC).compress(raw, asbytes=True)


def get(blob: bytes) -> np.ndarray:
    raw = pa.Codec(CODEC).decompress(blob[14:], decompressed_size=int(blob[2:14]), asbytes=True)
    a = np.frombuffer(raw, dtype=blob[:2].decode())
    return a.astype(np.int64) if a.dtype.kind == "u" and a.dtype.itemsize < 8 else a


def ascending(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=0)


def rising(a: np.ndarray) -> np.ndarray:
    """Steps of ascending numbers of 64 bits; ``np.cumsum`` undoes it."""
    return np.diff(a, prepend=np.uint64(0))


def risen(blob: bytes) -> np.ndarray:
    return np.cumsum(get(blob).astype(np.uint64), dtype=np.uint64)


def dictionary(a: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers of 64 bits as the distinct ones and the place of each there."""
    kinds, codes = np.unique(a, return_inverse=True)
    return put(rising(kinds)), put(codes)


def starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


@dataclass
class Sums:
    """Customers and tables of the endings (ascending), then tokens, words, root tables, and counts for the discounts
    of endings, root and preceding words; of the frequent words their occurrences and customers in the root."""

    contexts: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    extra: np.ndarray
    heavy: np.ndarray | None = None

    def __add__(self, other: Sums) -> Sums:
        contexts, at = np.unique(np.concatenate([self.contexts, other.contexts]), return_inverse=True)
        customers, tables = (np.bincount(at, weights=np.concatenate(x), minlength=len(contexts))
                             for x in ((self.customers, other.customers), (self.tables, other.tables)))
        heavy = [x.heavy for x in (self, other) if x.heavy is not None]
        return Sums(contexts, customers, tables, self.extra + other.extra, sum(heavy) if heavy else None)


EXTRA = 9
NOTHING = Sums(np.empty(0, np.int64), np.empty(0), np.empty(0), np.zeros(EXTRA))


@dataclass
class Totals:
    """What all buckets share: per ending its customers and tables, and the same of the shared restaurant.

    The arrays end with a place without customers for the endings that training does not have. ``heavy_*``: how often
    each frequent word occurs, and its customers and tables in the shared restaurant.
    """

    contexts: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    root_customers: float
    root_tables: float
    words: int
    tokens: int
    discount: float
    root_discount: float
    word_discount: float = 0.5
    heavy_counts: np.ndarray | None = None
    heavy_customers: np.ndarray | None = None
    heavy_tables: np.ndarray | None = None

    @property
    def uniform(self) -> float:
        return 1.0 / (self.words + 1)

    def root_probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        fresh = (STRENGTH + self.root_discount * self.root_tables) * self.uniform
        return (customers - self.root_discount * tables + fresh) / (STRENGTH + self.root_customers)

    def places(self, context: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.contexts, context)
        last = len(self.contexts)
        if not last:
            return at
        return np.where(self.contexts[np.minimum(at, last - 1)] == context, at, last)

    def probability(self, context: np.ndarray, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
        return self.probability_at(self.places(context), customers, tables, parent)

    def probability_at(self, place: np.ndarray, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
        back = (STRENGTH + self.discount * self.tables[place]) * parent
        return (customers - self.discount * tables + back) / (STRENGTH + self.customers[place])


def seated(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float,
           rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after seating its customers from none; ``others``: tables of other dishes there."""
    order = np.argsort(-customers, kind="stable")
    n, other, p = customers[order], others[order].astype(float), parent[order]
    tables = np.ones(len(n))
    sat, active = 1, len(n)
    while True:
        active = int(np.searchsorted(-n[:active], -sat, side="left"))  # dishes with customers left
        if not active:
            break
        t = tables[:active]
        fresh = (STRENGTH + discount * (other[:active] + t)) * p[:active]
        chance = fresh / (fresh + sat - discount * t)
        if sat < ONE_BY_ONE:
            group = 1
            tables[:active] += rng.random(active) < chance
        else:
            group = sat // 8
            tables[:active] += rng.binomial(np.minimum(group, n[:active] - sat).astype(np.int64), chance)
        sat += group
    out = np.empty(len(n))
    out[order] = tables
    return out


class Seating:
    """Words of one bucket: pairs (word, context) with their customers, sorted by word."""

    def __init__(self, lengths: np.ndarray, context: np.ndarray, customers: np.ndarray, number: int):
        known = customers > 0
        word = np.repeat(np.arange(len(lengths)), lengths)[known]
        self.n_words, self.number = len(lengths), number
        self.known, self.word, self.context, self.customers = known, word, context[known], customers[known].astype(float)
        self.contexts, self.nth = np.unique(self.context, return_inverse=True)
        self.tables = np.ones(len(word))
        self.root_customers = np.bincount(word, minlength=self.n_words).astype(float)
        self.root_tables = (self.root_customers > 0).astype(float)
        self.counts = np.bincount(word, weights=self.customers, minlength=self.n_words)

    def root(self, totals: Totals, places: np.ndarray | None = None) -> np.ndarray:
        """Probability of each word in the shared restaurant; ``places``: of frequent words, whose counts are shared."""
        if places is None:
            return totals.root_probability(self.root_customers, self.root_tables)
        return totals.root_probability(totals.heavy_customers[places], totals.heavy_tables[places])

    def sweep(self, totals: Totals, k: int, places: np.ndarray | None = None) -> None:
        """One pass over all dishes, given the totals of the sweep before; the shared tables of frequent words are not
        seated here, where only some of their customers are."""
        rng = np.random.default_rng([SEED, k, self.number])
        parent = self.root(totals, places)
        many = np.flatnonzero(self.customers > 1)
        there = totals.tables[totals.places(self.contexts)]
        others = np.maximum(there[self.nth[many]] - self.tables[many], 0)
        self.tables = np.ones(len(self.word))  # of dishes that have one customer now, whatever they had before
        self.tables[many] = seated(self.customers[many], others, parent[self.word[many]], totals.discount, rng)
        self.root_customers = np.bincount(self.word, weights=self.tables, minlength=self.n_words)
        if places is None:
            self.root_tables = root_seated(self.root_customers, totals, rng)

    def sums(self) -> Sums:
        extra = [self.customers.sum(), float((self.counts > 0).sum()), self.root_tables.sum(),
                 *times_once_twice(self.customers), *times_once_twice(self.root_customers), 0.0, 0.0]
        customers, tables = (np.bincount(self.nth, weights=w, minlength=len(self.contexts)) for w in (self.customers, self.tables))
        return Sums(self.contexts, customers, tables, np.array(extra))


def times_once_twice(counts: np.ndarray) -> tuple[float, float]:
    return float((counts == 1).sum()), float((counts == 2).sum())


def root_seated(customers: np.ndarray, totals: Totals, rng: np.random.Generator) -> np.ndarray:
    """Tables of each word in the shared restaurant, seated anew."""
    many = np.flatnonzero(customers > 1)
    tables = (customers > 0).astype(float)
    tables[many] = seated(customers[many], np.full(len(many), max(0.0, totals.root_tables - 1)),
                          np.full(len(many), totals.uniform), totals.root_discount, rng)
    return tables


class WordSeating:
    """Words of one bucket in the restaurants of the words before them, with what these send to those of endings.

    Pairs are sorted by word, ending and preceding word: ``lengths`` endings per word, ``sizes`` preceding words per
    ending, ``context`` the place of the preceding word, ``customers`` none where training has no such pair.
    ``places``: of frequent words.
    """

    def __init__(self, lengths: np.ndarray, ending: np.ndarray, sizes: np.ndarray, context: np.ndarray,
                 customers: np.ndarray, number: int, places: np.ndarray | None = None):
        self.context, self.customers, self.number, self.places = context, customers.astype(float), number, places
        self.pair = np.repeat(np.arange(len(sizes)), sizes)  # of word and ending
        self.word, self.ending = np.repeat(np.arange(len(lengths)), lengths), ending
        self.tables = (customers > 0).astype(float)
        self.below = Seating(lengths, ending, self._sent().astype(np.int64), number)
        self.counts = np.bincount(self.word[self.pair], weights=self.customers, minlength=len(lengths))

    def _sent(self) -> np.ndarray:
        return np.bincount(self.pair, weights=self.tables, minlength=len(self.word))

    def put(self) -> list[bytes]:
        return [put(a.astype(np.int64)) for a in (self.tables, self.below.tables, self.below.root_tables)]

    def take(self, blobs: list[bytes]) -> None:
        """The seating that ``put`` has written."""
        below = self.below
        self.tables, below.tables, below.root_tables = (get(b).astype(float) for b in blobs)
        below.customers = self._sent()[below.known]
        below.root_customers = np.bincount(below.word, weights=below.tables, minlength=below.n_words)

    def endings(self, totals: Totals) -> np.ndarray:
        """Probability of the word in the restaurant of the ending, for each word and ending."""
        tables = np.zeros(len(self.word))
        tables[self.below.known] = self.below.tables
        return totals.probability(self.ending, self._sent(), tables, self.below.root(totals, self.places)[self.word])

    def sweep(self, totals: Totals, k: int, there: np.ndarray) -> None:
        """One pass over all dishes; ``there``: tables of each preceding word's restaurant in the sweep before."""
        many = np.flatnonzero(self.customers > 1)
        self.tables[many] = seated(
            self.customers[many], np.maximum(there[self.context[many]] - self.tables[many], 0),
            self.endings(totals)[self.pair[many]], totals.word_discount, np.random.default_rng([SEED, k, self.number, 1]))
        self.below.customers = self._sent()[self.below.known]
        self.below.sweep(totals, k, self.places)

    def probability(self, totals: Totals, there: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Of each pair; ``own``: customers of each preceding word's restaurant."""
        back = (STRENGTH + totals.word_discount * there[self.context]) * self.endings(totals)[self.pair]
        return (self.customers - totals.word_discount * self.tables + back) / (STRENGTH + own[self.context])

    def sums(self, heavy_words: int) -> Sums:
        sums, heavy = self.below.sums(), np.zeros((2, heavy_words))
        sums.extra[0], sums.extra[1] = self.customers.sum(), float((self.counts > 0).sum())
        sums.extra[7:] = times_once_twice(self.customers)
        if self.places is not None:
            sums.extra[[1, 2, 5, 6]] = 0  # known only when all customers are
            heavy[:, self.places] = self.counts, self.below.root_customers
        return replace(sums, heavy=heavy)


def totals_of(sums: Sums, before: Totals | None = None, k: int = 0) -> Totals:
    """``before``: the totals by which sweep ``k`` was made, for the shared tables of frequent words."""
    extra = sums.extra.copy()
    counts, customers = sums.heavy if sums.heavy is not None else np.zeros((2, 0))
    tables = (customers > 0).astype(float)
    if before is not None:
        tables = root_seated(customers, before, np.random.default_rng([SEED, k]))
    extra[[1, 2, 5, 6]] += float((counts > 0).sum()), tables.sum(), *times_once_twice(customers)

    def share(once: float, twice: float) -> float:
        return float(np.clip(once / (once + 2 * twice) if once else 0.5, 0.05, 0.95))

    return Totals(sums.contexts, np.r_[sums.customers, 0.0], np.r_[sums.tables, 0.0], float(sums.tables.sum()), float(extra[2]),
                  int(extra[1]), int(extra[0]), share(extra[3], extra[4]), share(extra[5], extra[6]),
                  share(extra[7], extra[8]), counts, customers, tables)


def word_numbers(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array([*words, END], dtype=object), categorize=False)[:-1]


def endings(words: list[bytes]) -> np.ndarray:
    """The parent of the context each word makes for the one behind it, a number of its own for each ending; 0 for no
    bytes. The context itself is the whole word."""
    if not words:
        return np.empty(0, dtype=np.int64)
    tails = np.empty(len(words), dtype=object)
    tails[:] = [w[-ENDING:] for w in words]
    codes, kinds = pd.factorize(tails)
    return np.array([FIRST[len(k)] + int.from_bytes(k) for k in kinds], dtype=np.int64)[codes]


@dataclass
class Pairs:
    """Words of all texts of a batch, each text closed by the end, with the word before: each pair once, sorted by
    home, word and word before. Then per text how many pairs it has, which (ascending) and how often, and its
    tokens."""

    home: np.ndarray
    word: np.ndarray
    before: np.ndarray
    customers: np.ndarray
    sizes: np.ndarray
    pair: np.ndarray
    times: np.ndarray
    tokens: np.ndarray


def pairs_of(texts: list[str], train: np.ndarray, buckets: int, heavy: np.ndarray) -> Pairs:
    """``home``: the bucket of frequent words, ``buckets`` more for others. ``word`` is the place of a frequent one."""
    lists = [ascii_words(t) for t in texts]
    tokens = np.array([len(x) + 1 for x in lists], dtype=np.int64)
    flat = np.empty(int(tokens.sum()), dtype=object)
    flat[:] = [w for x in lists for w in (*x, END)]
    codes, kinds = pd.factorize(flat)
    kinds = [*kinds.tolist(), END]  # as the word before: the start of a text
    number, ending, n = word_numbers(kinds), endings(kinds), len(kinds)
    context = (ending.astype(np.uint64) << ENDING_BIT) | (number >> (np.uint64(64) - ENDING_BIT))
    before = np.r_[n - 1, codes[:-1]]
    before[starts(tokens)] = n - 1
    found, pair = np.unique(codes * n + before, return_inverse=True)
    word, before = found // n, found % n
    place = np.searchsorted(heavy, number)
    frequent = heavy[np.minimum(place, max(0, len(heavy) - 1))] == number if len(heavy) else np.zeros(n, bool)
    spread = mixed((place[word].astype(np.uint64) << np.uint64(32)) | ending[before].astype(np.uint64))
    home = np.where(frequent[word], spread % np.uint64(buckets), home_of(number, buckets)[word] + np.uint64(buckets)).astype(np.int64)
    # Ranks instead of numbers, so that one integer sorts by all.
    ranks = np.empty((2, n), dtype=np.int64)
    for rank, order in zip(ranks, (np.argsort(number, kind="stable"), np.argsort(context, kind="stable"))):
        rank[order] = np.arange(n)
    order = np.argsort((home * n + ranks[0][word]) * n + ranks[1][before])
    at = np.empty(len(order), dtype=np.int64)
    at[order] = np.arange(len(order))
    text = np.repeat(np.arange(len(texts)), tokens)
    key, times = np.unique(text * len(order) + at[pair], return_counts=True)
    text, pair = key // len(order), key % len(order)
    customers = np.bincount(pair, weights=times * train[text], minlength=len(order)).astype(np.int64)
    word, before = word[order], before[order]
    return Pairs(home[order], np.where(frequent[word], place[word].astype(np.uint64), number[word]), context[before], customers, np.bincount(text, minlength=len(texts)), pair, times, tokens)


#: Where the number of the ending begins in the number of a word as a context; below it lie bits of the word's own, by
#: which words of one ending are told apart.
ENDING_BIT = np.uint64(64 - CONTEXTS.bit_length())


def home_of(number: np.ndarray, buckets: int) -> np.ndarray:
    return (number >> np.uint64(16)) % np.uint64(buckets)


#: A row of packed arrays: what it is, the group it goes to, whether of frequent words, and where it comes from.
PACKED = "kind string, bucket int, part string, at long, blobs array<binary>"
PARTS = ("heavy", "words")


def packed(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.binary()))
    columns = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["kind", "bucket", "part", "at", "blobs"])


@contextmanager
def releasing(spark: SparkSession):
    """Shuffle files go when the query that made them has ended, as its result is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def kept(df: DataFrame, name: str) -> str:
    """Folder with the written rows, one folder inside for each kind."""
    path = fresh_path(df.sparkSession, name)
    with releasing(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    return path


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(PACKED).parquet(path).where(F.col("kind") == kind).select("kind", "bucket", "part", "at", "blobs")


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "bucket", "part", "at", "blobs"])


def counted(docs: DataFrame, training: Column, buckets: int, heavy: np.ndarray) -> DataFrame:
    """What batches of texts ask of each bucket (``ask``: words, pairs per word, words before, customers), and
    what they keep (``facts``: ids, tokens, pairs of the texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in sized(batches, size=BATCH_BYTES):
            for at in range(0, batch.num_rows, 50_000):
                part = batch.slice(at, 50_000)
                first = (task << 36) + row
                row += part.num_rows
                train = np.array(part.column("train").to_pylist(), dtype=np.int64)
                p = pairs_of(part.column("text").to_pylist(), train, buckets, heavy)
                cuts = np.searchsorted(p.home, np.arange(2 * buckets + 1))
                rows = []
                for b, (a, z) in enumerate(zip(cuts.tolist(), cuts.tolist()[1:])):
                    if a < z:
                        new = np.flatnonzero(np.r_[True, p.word[a + 1:z] != p.word[a:z - 1]])
                        rows.append(("ask", b % buckets, PARTS[b // buckets], first, [
                            put(rising(p.word[a:z][new])), put(np.diff(np.r_[new, z - a])), *dictionary(p.before[a:z]),
                            put(p.customers[a:z])]))
                ids = part.column("doc_id").to_pylist()
                missing = np.array([x is None for x in ids], dtype=np.int64)
                values = np.array([x or 0 for x in ids], dtype=np.int64)
                step = ascending(p.pair)
                some = p.sizes > 0
                step[starts(p.sizes)[some]] = p.pair[starts(p.sizes)[some]]  # a text's first one is written in full
                spread = int(mixed(np.array([first], dtype=np.uint64))[0] % np.uint64(buckets))
                rows.append(("facts", spread, "", first, [
                    values.tobytes(), put(missing), put(p.tokens), put(p.sizes), put(step), put(p.times)]))
                yield packed(rows)

    rows = texts_of(docs.withColumn("train", F.coalesce(training, F.lit(False)).cast("int")), "train")
    return rows.mapInArrow(run, PACKED)


def coded(blobs: list[bytes]) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """The distinct numbers of several ascending lists, and of each list the places of its numbers there."""
    lists = [risen(b) for b in blobs]
    kinds, codes = np.unique(np.concatenate(lists), return_inverse=True)
    ends = np.cumsum([len(x) for x in lists]).tolist()
    return kinds, (codes[a:z] for a, z in zip([0, *ends], ends))


def merged_pairs(asked: list[list[bytes]], named: bool, buckets: int) -> tuple[list[bytes], list[bytes]]:
    """Blobs of the state from what all batches ask for, and for each batch which pairs these are."""
    names, words = coded([b[0] for b in asked])
    numbers, befores = coded([b[2] for b in asked])
    # One integer sorts by word, ending and preceding word.
    key = np.concatenate([np.repeat(word * len(numbers), get(b[1])) + before[get(b[3])]
                          for word, before, b in zip(words, befores, asked)])
    pairs, index = np.unique(key, return_inverse=True)
    del key
    customers = np.bincount(index, weights=np.concatenate([get(b[4]) for b in asked])).astype(np.int64)
    ends = np.cumsum([int(get(b[1]).sum()) for b in asked]).tolist()
    asks = [put(ascending(index[a:z])) for a, z in zip([0, *ends], ends)]
    del index
    word, context = pairs // len(numbers), pairs % len(numbers)
    ending = (numbers >> ENDING_BIT)[context]
    new_word = np.r_[True, word[1:] != word[:-1]]
    new_ending = new_word | np.r_[True, ending[1:] != ending[:-1]]
    at = np.flatnonzero(new_ending)
    sizes, lengths = (np.diff(np.r_[np.flatnonzero(new), len(new)]) for new in (new_ending, new_word[at]))
    by_home = np.argsort(home_of(numbers, buckets), kind="stable")
    place = np.empty(len(numbers), dtype=np.int64)
    place[by_home] = np.arange(len(numbers))
    return [put(names.astype(np.int64) if named else np.empty(0, np.int64)), put(lengths), put(sizes), put(numbers[by_home]),
            put(place[context]), put(customers)], asks


def merger(buckets: int, heavy_words: int):
    def merged(group: pd.DataFrame) -> pd.DataFrame:
        """Per part the pairs of all batches (``state``: frequent words, endings per word, preceding words per ending,
        their numbers by home, and of each pair the place of its preceding word and customers), what is sent before
        the first sweep, and which pairs each batch asks for (``ask``). Facts stay as they are."""
        out, bucket = [], int(group["bucket"].iloc[0])
        for name in PARTS:
            rows = group[(group["kind"] == "ask") & (group["part"] == name)]
            if not len(rows):
                continue
            blobs, asks = merged_pairs(rows["blobs"].tolist(), name == "heavy", buckets)
            out.append(("state", bucket, name, 0, blobs))
            out += [("ask", bucket, name, first, [ask]) for first, ask in zip(rows["at"], asks)]
            out += sent(seating_of(bucket, name, blobs), get(blobs[3]).astype(np.uint64), bucket, name, buckets, heavy_words, True)
        facts = group[group["kind"] == "facts"]
        return pd.concat([frame(out), facts], ignore_index=True) if len(facts) else frame(out)

    return merged


def seating_of(bucket: int, part: str, blobs: list[bytes], seats: list[bytes] | None = None) -> WordSeating:
    """The seating before the first sweep, or as it was written after one."""
    names, lengths, sizes, numbers, context, customers = (get(x) for x in blobs)
    ending = (numbers.astype(np.uint64)[context[starts(sizes)]] >> ENDING_BIT).astype(np.int64)
    seating = WordSeating(lengths, ending, sizes, context, customers, 2 * bucket + PARTS.index(part),
                          names if part == "heavy" else None)
    if seats is not None:
        seating.take(seats)
    return seating


def sent(seating: WordSeating, numbers: np.ndarray, bucket: int, part: str, buckets: int, heavy_words: int,
         first: bool) -> list[tuple]:
    """What a bucket tells others of its seating: its sums (``sums``), and to the home of each preceding word that
    word's tables here and (the first time) customers (``asked``)."""
    weights = [seating.tables, seating.customers] if first else [seating.tables]
    here = [np.bincount(seating.context, weights=w, minlength=len(numbers)).astype(np.int64) for w in weights]
    cuts = np.searchsorted(home_of(numbers, buckets), np.arange(buckets + 1)).tolist()
    rows = [("asked", home, part, bucket, [put(rising(numbers[a:z])), *(put(x[a:z]) for x in here)])
            for home, (a, z) in enumerate(zip(cuts, cuts[1:])) if a < z]
    sums = seating.sums(heavy_words)
    arrays = (sums.contexts, sums.customers, sums.tables, sums.extra, sums.heavy.ravel())
    return [*rows, ("sums", bucket, part, 0, [put(a.astype(np.int64)) for a in arrays])]


def summed_up(sums: DataFrame, heavy_words: int) -> Sums:
    """Sums over all buckets; to the driver comes one row for each ending that occurs in training and for each of
    the bounded number of frequent words. Valid UTF-8 without white space has at most some 2.5 million endings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = replace(NOTHING, heavy=np.zeros((2, heavy_words)))
        for batch in batches:
            for blobs in batch.column(0).to_pylist():
                contexts, *values = map(get, blobs)
                customers, tables, extra, heavy = (x.astype(float) for x in values)
                total += Sums(contexts, customers, tables, extra, heavy.reshape(2, heavy_words))
        # The sums without an ending have negative numbers.
        slot = np.r_[np.arange(-EXTRA - heavy_words, 0), total.contexts]
        customers, tables = np.r_[total.heavy[0], total.extra, total.customers], np.r_[total.heavy[1], np.zeros(EXTRA), total.tables]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int32()), pa.array(customers), pa.array(tables)], ["slot", "customers", "tables"])

    with releasing(sums.sparkSession):
        found = (sums.select("blobs").mapInArrow(run, "slot int, customers double, tables double").groupBy("slot")
                 .agg(F.sum("customers").alias("customers"), F.sum("tables").alias("tables")).toArrow().sort_by("slot"))
    slot, customers, tables = (found.column(c).to_numpy() for c in ("slot", "customers", "tables"))
    fixed = np.zeros((2, heavy_words + EXTRA))
    fixed[:, slot[slot < 0] + EXTRA + heavy_words] = customers[slot < 0], tables[slot < 0]
    return Sums(slot[slot >= 0].astype(np.int64), customers[slot >= 0], tables[slot >= 0], fixed[0, heavy_words:], fixed[:, :heavy_words])


def shared(asked: DataFrame) -> DataFrame:
    """For every bucket the tables (and customers, before the first sweep) of the preceding words' restaurants in all
    buckets, by the home of the word: a row per bucket, part and home, in the order of the bucket's words."""

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        asked = [[risen(blobs[0]), *map(get, blobs[1:])] for blobs in group["blobs"]]
        numbers = np.concatenate([a[0] for a in asked])
        _, at = np.unique(numbers, return_inverse=True)
        totals = [np.bincount(at, weights=np.concatenate([a[k] for a in asked])).astype(np.int64)[at] for k in range(1, len(asked[0]))]
        ends = np.cumsum([len(a[0]) for a in asked]).tolist()
        return frame([("answer", bucket, part, home, [put(x[a:z]) for x in totals])
                      for home, part, bucket, a, z in zip(group["bucket"], group["part"], group["at"], [0, *ends], ends)])

    return asked.groupBy("bucket").applyInPandas(answer, PACKED)


def received(group: pd.DataFrame) -> list[np.ndarray]:
    """The answers to a bucket from all homes: tables, and the first time customers."""
    answers = [[get(x) for x in blobs] for blobs in group[group["kind"] == "answer"].sort_values("at")["blobs"]]
    return [np.concatenate([a[k] for a in answers]) for k in range(len(answers[0]))]


def the(group: pd.DataFrame, kind: str, at: int = 0) -> list[bytes] | None:
    found = group[(group["kind"] == kind) & (group["at"] == at)]
    return list(found["blobs"].iloc[0]) if len(found) else None


def swept(rows: DataFrame, totals: Totals, k: int, buckets: int, heavy_words: int) -> DataFrame:
    """Sweep ``k`` over ``rows`` of state, seats and answers: the new seats (``seats``), the answers (``there``), and
    what is sent."""

    def sweep(group: pd.DataFrame) -> pd.DataFrame:
        bucket, part, blobs = int(group["bucket"].iloc[0]), group["part"].iloc[0], the(group, "state")
        seating, there = seating_of(bucket, part, blobs, the(group, "seats", k)), received(group)
        seating.sweep(totals, k, there[0].astype(float))
        return frame([("seats", bucket, part, k + 1, seating.put()), ("there", bucket, part, k, [put(x) for x in there]),
                      *sent(seating, get(blobs[3]).astype(np.uint64), bucket, part, buckets, heavy_words, False)])

    return rows.groupBy("bucket", "part").applyInPandas(sweep, PACKED)


def probabilities(rows: DataFrame, history: list[Totals], burn_in: int) -> DataFrame:
    """Of each pair of each bucket (``rows`` of state, seats and answers): log10 of the mean probability after the
    sweeps behind burn-in, and how often the word occurs in training (``values``)."""
    last = len(history) - 1

    def values(group: pd.DataFrame) -> pd.DataFrame:
        bucket, part = int(group["bucket"].iloc[0]), group["part"].iloc[0]
        seating, own = seating_of(bucket, part, the(group, "state")), get(the(group, "there")[1]).astype(float)
        mean = np.zeros(len(seating.context))
        for k in range(burn_in + 1, last + 1):
            seating.take(the(group, "seats", k))
            there = received(group)[0] if k == last else get(the(group, "there", k)[0])
            mean += seating.probability(history[k], there.astype(float), own) / (last - burn_in)
        counts = seating.counts if seating.places is None else history[-1].heavy_counts[seating.places]
        count = counts.astype(np.int64)[seating.word[seating.pair]]
        return frame([("values", bucket, part, 0, [put(np.log10(mean).astype("f4")), put(count)])])

    return rows.groupBy("bucket", "part").applyInPandas(values, PACKED)


def answered(rows: DataFrame) -> DataFrame:
    """To each batch the values of the pairs it asks for (``rows`` of values and asks)."""

    def values(group: pd.DataFrame) -> pd.DataFrame:
        value, count = map(get, the(group, "values"))
        asks = group[group["kind"] == "ask"]
        index = (np.cumsum(get(blobs[0])) for blobs in asks["blobs"])
        return frame([("value", bucket, part, at, [put(value[i]), put(count[i])])
                      for bucket, part, at, i in zip(asks["bucket"], asks["part"], asks["at"], index)])

    return rows.groupBy("bucket", "part").applyInPandas(values, PACKED)


def frequent_words(docs: DataFrame, buckets: int, fraction: float = 0.01) -> np.ndarray:
    """Numbers of words with at least one bucket's share of a sample's tokens, ascending, at most
    ``HEAVY_WORDS``. They decide where words are handled, not how."""
    words = texts_of(docs).sample(fraction, seed=SEED).select(
        F.explode(F.split(ascii_lower(F.col("text")), "[ \t-\r]+")).alias("word")).where("word <> ''")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(HEAVY_WORDS).toPandas()
    total = max(1, words.count())
    chosen = [w.encode("utf-8") for w, n in zip(counts["word"], counts["n"]) if n * buckets >= total]
    return np.sort(word_numbers(chosen))


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for all texts, by their bytes: a bucket is one task's group, so it must not grow with the table."""
    size = texts_of(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-int(size) // bucket_bytes))


def scored(docs: DataFrame, training: Column, sweeps: int = SWEEPS, burn_in: int = BURN_IN,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Log10 probability of every whole text under the model and under smoothed word counts.

    ``docs``: ``doc_id``, ``text`` (null: empty); other columns are ignored. ``training`` is a condition on the
    rows of ``docs`` that chooses what counts are taken from; a null counts as not chosen. Words lie between
    white space (space, tab to carriage return), A-Z in lower case, and every text ends with one end token.
    Result, one row per input row, repeated rows included: ``doc_id``, ``n_tokens``, ``n_known`` (tokens met in
    training), ``train_tokens``, ``base_score`` (sum of log10((c + 0.5) / (N + 0.5 (V + 1)))), ``score``. An
    empty text is the end alone. Without training rows every token has probability one. An empty table gives an
    empty result.
    """
    buckets = bucket_count(docs, bucket_bytes)
    heavy = frequent_words(docs, buckets)
    spark, words = docs.sparkSession, len(heavy)
    pairs = kept(counted(docs, training, buckets, heavy).groupBy("bucket").applyInPandas(merger(buckets, words), PACKED), "pairs")
    state, newest, history, seats = read(spark, pairs, "state"), pairs, [], []
    history = [totals_of(summed_up(read(spark, pairs, "sums"), words))]
    for k in range(sweeps):
        rows = state.unionByName(shared(read(spark, newest, "asked")))
        if seats:
            rows = rows.unionByName(read(spark, newest, "seats"))
        before, newest = newest, kept(swept(rows, history[k], k, buckets, words), "seating")
        for kind in ("asked", "sums"):
            removed(spark, f"{before}/kind={kind}")
        seats.append(newest)
        history.append(totals_of(summed_up(read(spark, newest, "sums"), words), history[k], k))
    rows = state.unionByName(shared(read(spark, newest, "asked")))
    for path in seats:
        rows = rows.unionByName(read(spark, path, "seats")).unionByName(read(spark, path, "there"))
    values = kept(probabilities(rows, history, burn_in), "probabilities")
    for path in (*seats, f"{pairs}/kind=state"):
        removed(spark, path)
    found = answered(read(spark, values, "values").unionByName(read(spark, pairs, "ask")))
    facts = read(spark, pairs, "facts")
    final = history[-1]
    tokens, smooth = final.tokens, final.tokens + 0.5 * (final.words + 1)

    def gathered(group: pd.DataFrame) -> pd.DataFrame:
        r = group[group["kind"] == "facts"].iloc[0]
        ids, (missing, counts, sizes, step, times) = np.frombuffer(r["blobs"][0], dtype=np.int64), map(get, r["blobs"][1:])
        values = group[group["kind"] == "value"].sort_values(["part", "bucket"])
        value, count = (np.concatenate([get(x[k]) for x in values["blobs"]]) for k in (0, 1))
        run = np.cumsum(step)
        pair = run - np.repeat((run - step)[np.minimum(starts(sizes), len(step) - 1)], sizes)
        text = np.repeat(np.arange(len(sizes)), sizes)
        base = np.log10((count + 0.5) / smooth)
        score, plain, known = (np.bincount(text, weights=x[pair] * times, minlength=len(sizes))
                               for x in (value.astype(float), base, (count > 0).astype(float)))
        return pd.DataFrame({
            "doc_id": pd.array(ids, dtype="Int64").copy() if not missing.any() else pd.array(
                [None if m else int(i) for i, m in zip(ids, missing)], dtype="Int64"),
            "n_tokens": counts, "n_known": known.round().astype(np.int64), "train_tokens": tokens,
            "base_score": plain, "score": score})

    return found.unionByName(facts).groupBy("at").applyInPandas(
        gathered, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
