"""Language of whole texts by a linear-chain conditional random field over their words.

Every word is a position, every learned language a label. Affix, character n-gram and lexicon features
(hashed) give a word its label scores, a learned matrix scores the step from label to label, and
forward-backward gives each word its label probabilities, also where a text switches languages. A text gets
the language with the largest sum over its words.

Training needs sequences in which languages change: runs of words of labelled documents are spliced together.
The model is fitted on a bounded sample of labelled rows (``sample_rows``, and some of every language); all texts
are scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbcast.llm.common import mixed, sized, texts_of

UNDECIDED = "und"
#: Labelled documents the model is fitted on; drawn by a hash of their id, whole texts.
SAMPLE_ROWS = 1500
#: Rows of each language that are learned from at least, or all if there are fewer.
LEAST_ROWS = 50
#: Hashed feature slots, words per spliced sequence, shortest and longest run, sequences per step, passes.
SLOTS, SEQUENCE, RUN, STEP_SEQUENCES, PASSES = 1 << 17, 96, (6, 64), 256, 3
RATE, DECAY = 0.25, 1e-6
SEED = 11
#: Words whose scores one Python worker remembers.
REMEMBERED = 400_000
#: New words whose features are held at once, and bytes of text that are labelled together: what a task holds beside its rows.
WORDS_AT_ONCE, TEXT_AT_ONCE = 8_192, 1_000_000
#: Words per column when long streams are processed in columns side by side.
COLUMN = 128
LETTER = re.compile(r"[^\W\d_]")
EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
#: Longest stretch of a word whose n-grams count; affixes and the whole word always do.
AFFIXES, GRAMS = (1, 2, 3), (1, 2, 3)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of all words, one after another, and the number of each word's features."""
    low = [EDGES.sub("", w).lower() for w in words]
    length = np.array([len(w) for w in low], dtype=np.int64)
    # Each word between two marks; its number is repeated along its characters.
    flat = np.frombuffer("".join([f"\x02{w}\x03" for w in low]).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    begin = np.concatenate([[0], np.cumsum(length + 2)[:-1]]) if len(low) else np.empty(0, dtype=np.int64)
    word = np.repeat(np.arange(len(low)), length + 2)
    slots, owner = [], []

    def add(kind: int, value: np.ndarray, of: np.ndarray) -> None:
        slots.append((mixed(value + np.uint64(kind * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(20)) % np.uint64(SLOTS))
        owner.append(of)

    rolling = np.zeros(len(flat), dtype=np.uint64)
    sums = {}
    for n in range(1, max(*GRAMS, *AFFIXES) + 2):
        # rolling[i]: hash of the n characters that start at i
        rolling = flat.copy() if n == 1 else np.concatenate(
            [rolling[:len(flat) - n + 1] * np.uint64(0x100000001B3) ^ flat[n - 1:], np.zeros(min(n - 1, len(flat)), dtype=np.uint64)])
        sums[n] = rolling
        if n in GRAMS and n > 1:
            at = np.flatnonzero(word[:len(flat) - n + 1] == word[n - 1:])
            add(n, rolling[at], word[at])
    for n in AFFIXES:
        has = np.flatnonzero(length >= n)
        add(10 + n, sums[n + 1][begin[has]], has)  # with the opening mark
        add(20 + n, sums[n + 1][begin[has] + length[has] + 1 - n], has)  # with the closing mark
    has = np.flatnonzero(length > 0)
    if len(has):
        whole = pd.util.hash_array(np.array([low[i] for i in has], dtype=object), categorize=False)
        add(30, whole, has)
    if not slots:
        return np.empty(0, dtype=np.int64), np.zeros(len(low), dtype=np.int64)
    slot, of = np.concatenate(slots).astype(np.int64), np.concatenate(owner)
    order = np.argsort(of, kind="stable")
    return slot[order], np.bincount(of, minlength=len(low))


def summed(weights: np.ndarray, slot: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Label scores per word: the mean-scaled sum of its features' weights; a word without features scores 0."""
    out = np.zeros((len(count), weights.shape[1]))
    has = count > 0
    if has.any():
        start = np.concatenate([[0], np.cumsum(count[has])[:-1]])
        out[has] = np.add.reduceat(weights[slot], start, axis=0) / np.sqrt(count[has])[:, None]
    return out


def chain_expectations(emission: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains of one length, ``emission`` [chains, words, labels]: the probabilities of the
    labels of every word, and the expected number of each change of labels over all chains, from the messages."""
    e = np.exp(emission - emission.max(axis=2, keepdims=True))
    pi, a = np.exp(start - start.max()), np.exp(step - step.max())
    length = e.shape[1]
    alpha, beta = np.empty_like(e), np.ones_like(e)
    alpha[:, 0] = pi * e[:, 0]
    for t in range(length):
        if t:
            alpha[:, t] = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] /= alpha[:, t].sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        beta[:, t] = (e[:, t + 1] * beta[:, t + 1]) @ a.T
        beta[:, t] /= beta[:, t].max(axis=1, keepdims=True)
    marginal = alpha * beta
    marginal /= marginal.sum(axis=2, keepdims=True)
    # A pair's probability: what leads to its first label, the change, its second word, what follows.
    right = (e * beta)[:, 1:]
    total = ((alpha[:, :-1] @ a) * right).sum(axis=2, keepdims=True)
    return marginal, np.einsum("cti,ctj->ij", alpha[:, :-1] / total, right) * a


def label_marginals(emission: np.ndarray, first: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Forward-backward over a stream of chains: ``emission`` [words, labels] are scores, ``first`` marks the
    first word of each chain, ``start`` and ``step`` are scores of the first label and of label changes.

    The stream is laid out in columns of equal length that are processed side by side: the product of each
    column's transfer matrices first, then the messages between columns, then those inside. A chain's first
    word has a transfer matrix with equal rows, which makes chains independent.
    """
    n, labels = emission.shape
    if not n:
        return np.zeros((0, labels))
    columns = -(-n // COLUMN)
    padded = columns * COLUMN
    e = np.ones((padded, labels))
    e[:n] = np.exp(emission - emission.max(axis=1, keepdims=True))
    reset = np.zeros(padded, dtype=bool)
    reset[:n] = first
    reset[n:] = True  # padding: chains of one neutral word
    e, reset = e.reshape(columns, COLUMN, labels), reset.reshape(columns, COLUMN)
    pi, a = np.exp(start - start.max()), np.exp(step - step.max())

    resets = [np.flatnonzero(r) for r in reset.T]

    def forward(v: np.ndarray, t: int) -> np.ndarray:
        """Row vectors [columns, rows, labels] through the transfer matrix of place t."""
        out = (v.reshape(-1, labels) @ a).reshape(v.shape)
        if len(resets[t]):
            out[resets[t]] = v[resets[t]].sum(axis=2, keepdims=True) * pi
        out *= e[:, t, None, :]
        out /= np.maximum(out.reshape(columns, -1).max(axis=1), 1e-300)[:, None, None]
        return out

    product = np.broadcast_to(np.eye(labels), (columns, labels, labels)).copy()
    for t in range(COLUMN):
        product = forward(product, t)
    enter = np.empty((columns, 1, labels))  # message that enters each column from the left
    leave = np.empty((columns, labels))  # and from the right
    message = np.ones(labels)
    for c in range(columns):
        enter[c, 0] = message
        message = message @ product[c]
        message = message / message.sum()
    message = np.ones(labels)
    for c in range(columns - 1, -1, -1):
        leave[c] = message
        message = product[c] @ message
        message = message / message.max()
    alpha = np.empty((COLUMN, columns, labels))
    for t in range(COLUMN):
        enter = forward(enter, t)
        alpha[t] = enter[:, 0]
    out = np.empty((columns, COLUMN, labels))
    beta = leave
    for t in range(COLUMN - 1, -1, -1):
        both = alpha[t] * beta
        out[:, t] = both / np.maximum(both.sum(axis=1, keepdims=True), 1e-300)
        beta = (e[:, t] * beta) @ a.T
        beta[resets[t]] = 1.0
        beta /= np.maximum(beta.max(axis=1, keepdims=True), 1e-300)
    return out.reshape(padded, labels)[:n]


class Field:
    """The conditional random field: feature weights [slots, labels], start and step scores."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        k = len(labels)
        self.weights, self.start, self.step = np.zeros((SLOTS, k)), np.zeros(k), np.zeros((k, k))
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, k), dtype=np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        """Label scores of each word. Scores of words already met by this worker come from its memory, which
        is emptied when full."""
        codes, distinct = pd.factorize(np.array(words, dtype=object))
        distinct = distinct.tolist()
        if len(self.place) + len(distinct) > len(self.known):
            self.place, self.known = {}, np.zeros((max(REMEMBERED, len(distinct)), len(self.labels)), dtype=np.float32)
        place = self.place
        new = [w for w in distinct if w not in place]
        if new:
            at = len(place)
            for some in range(0, len(new), WORDS_AT_ONCE):
                part = new[some:some + WORDS_AT_ONCE]
                self.known[at + some:at + some + len(part)] = summed(self.weights, *word_features(part))
            place.update(zip(new, range(at, at + len(new))))
        return self.known[np.array([place[w] for w in distinct], dtype=np.int64)][codes].astype(np.float64)

    def fit(self, texts: list[tuple[str, str]]) -> "Field":
        """Maximum likelihood by adaptive gradient steps over spliced sequences."""
        rng = np.random.default_rng(SEED)
        place = {label: i for i, label in enumerate(self.labels)}
        runs: list[tuple[list[str], int]] = []
        for text, label in texts:
            words, at = text.split(), 0
            while at < len(words):
                size = int(rng.integers(*RUN))
                runs.append((words[at:at + size], place[label]))
                at += size
        # Languages take turns as if equally frequent, so that a rare one is learned as well.
        by_label = [[r for r in runs if r[1] == i] for i in range(len(self.labels))]
        weight = np.array([len(b) ** 0.5 for b in by_label])
        order: list[tuple[list[str], int]] = []
        for i in rng.choice(len(by_label), size=len(runs), p=weight / weight.sum()) if runs else []:
            order.append(by_label[i][int(rng.integers(len(by_label[i])))])
        words = [w for r, _ in order for w in r]
        truth = np.array([label for r, label in order for _ in r], dtype=np.int64)
        chains = len(words) // SEQUENCE
        if not chains:
            chains, size = min(1, len(words)), len(words)
        else:
            size = SEQUENCE
        if not chains or len(self.labels) < 2:
            return self
        codes, distinct = pd.factorize(np.array(words[:chains * size], dtype=object))
        slot, count = word_features(list(distinct))
        begin = np.concatenate([[0], np.cumsum(count)[:-1]])
        k = len(self.labels)
        seen = [np.full(x.shape, 1e-2) for x in (self.weights, self.start, self.step)]
        for _ in range(PASSES):
            for some in np.array_split(rng.permutation(chains), max(1, chains // STEP_SEQUENCES)):
                at = (some[:, None] * size + np.arange(size)).ravel()
                kinds, local = np.unique(codes[at], return_inverse=True)
                width = count[kinds]
                pick = np.repeat(begin[kinds] - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
                slots = slot[pick]
                emission = summed(self.weights, slots, width)[local]
                marginal, expected = chain_expectations(emission.reshape(len(some), size, k), self.start, self.step)
                first = marginal[:, 0]
                marginal = marginal.reshape(len(at), k)
                error = -marginal
                error[np.arange(len(at)), truth[at]] += 1
                t = truth[at].reshape(len(some), size)
                observed = np.bincount((t[:, :-1] * k + t[:, 1:]).ravel(), minlength=k * k).reshape(k, k)
                step_gradient = (observed - expected) / max(1, len(at))
                start_gradient = (np.bincount(t[:, 0], minlength=k) - first.sum(axis=0)) / len(some)
                per_kind = np.stack([np.bincount(local, weights=error[:, j], minlength=len(kinds)) for j in range(k)], axis=1)
                spread = np.repeat(per_kind / np.sqrt(np.maximum(width, 1))[:, None], width, axis=0)
                gradient = np.stack([np.bincount(slots, weights=spread[:, j], minlength=SLOTS) for j in range(k)], axis=1) / len(some)
                gradient -= DECAY * self.weights
                for value, g, total in zip((self.weights, self.start, self.step), (gradient, start_gradient, step_gradient), seen):
                    total += g * g
                    value += RATE * g / np.sqrt(total)
        self.weights = self.weights.astype(np.float32)
        return self

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and its mean probability over the words of each text."""
        lists = [t.split() if LETTER.search(t) else [] for t in texts]
        counts = np.array([len(x) for x in lists])
        names, scores = [UNDECIDED] * len(texts), [0.0] * len(texts)
        has = np.flatnonzero(counts > 0)
        if not len(has) or not self.labels:
            return names, scores
        start = np.concatenate([[0], np.cumsum(counts[has])[:-1]])
        emission = self.scores([w for x in lists for w in x])
        first = np.zeros(len(emission), dtype=bool)
        first[start] = True
        # Words without a letter follow their neighbours and have no say of their own.
        says = np.abs(emission).sum(axis=1) > 0
        marginal = label_marginals(emission, first, self.start, self.step)
        total = np.add.reduceat(marginal * np.where(says, 1.0, 1e-6)[:, None], start, axis=0)
        total /= total.sum(axis=1, keepdims=True)
        for i, row in zip(has.tolist(), total):
            best = int(row.argmax())
            names[i], scores[i] = self.labels[best], float(row[best])
        return names, scores


def fitted(docs: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS) -> Field:
    """A field learned from a sample of the rows that meet ``training`` and have a language and a letter.

    The sample are the ``sample_rows`` rows with the smallest hash of their id and, so that every language is
    learned, the ``LEAST_ROWS`` of each language with the smallest hash. Only the sampled rows come to the driver.
    """
    lang = F.col("lang").cast("string")
    rows = texts_of(docs, "lang").where(training & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("doc_id", "text", lang.alias("lang"))
    hashed = rows.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(SEED)).alias("h"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    of_each = hashed.withColumn("place", place).where(F.col("place") <= LEAST_ROWS)
    chosen_rows = [(r[0], r[1]) for r in hashed.orderBy("h", "doc_id").limit(sample_rows).collect()]
    of_each_rows = [(r[0], r[1]) for r in of_each.select("doc_id", "lang").collect()]
    keys = docs.sparkSession.createDataFrame(sorted({*chosen_rows, *of_each_rows}, key=lambda k: (k[0] is None, k)),
                                             "id long, name string")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("lang") == F.col("name"))
    chosen = rows.join(F.broadcast(keys), same, "left_semi").collect()
    found = sorted(chosen, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    # Repeated ids bring more rows than were chosen: the first of every language stay, others as far as there is room.
    seen, early, late = Counter(), [], []
    for r in found:
        seen[r[2]] += 1
        (early if seen[r[2]] <= LEAST_ROWS else late).append(r)
    room = max(0, max(sample_rows, len({*chosen_rows, *of_each_rows})) - len(early))
    kept = sorted([*early, *late[:room]], key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    return Field(sorted(seen)).fit([(r[1], r[2]) for r in kept])


def languages(docs: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Language of every whole text.

    ``docs``: ``doc_id``, ``text``, ``lang``; other columns are ignored, and ``lang`` is read from rows that
    meet ``training`` only. Result, one row per input row, repeated rows included: ``doc_id``, ``lang_pred``,
    ``score`` (mean probability of that language over the words; 0 for ``und``). A null text or one without a
    letter is ``und``, as is everything if there is nothing to learn from. Equal sums go to the language first
    in alphabetical order. A null ``doc_id`` stays null; an empty table gives an empty result.
    """
    field = fitted(docs, training, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, size=TEXT_AT_ONCE):
            names, scores = field.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def in_language(docs: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS, least: float = 0.0) -> DataFrame:
    """``docs`` with all its columns, without the rows whose language stays undecided or scores below ``least``."""
    field = fitted(docs, training, sample_rows)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, size=TEXT_AT_ONCE):
            names, scores = field.predict([t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array([n != UNDECIDED and s >= least for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
