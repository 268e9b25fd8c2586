"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

The features approximate a Gaussian kernel; tasks add up the normal equations of their rows, Spark sums those
by matrix cell, and only the summed system reaches the driver. The ridge weight is the one with the least
squared error across two folds, which the sums of each fold give without another pass; the calibration is
fitted on scores of the other fold's model.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import slices, stored, texts_of
from kerbcast.llm.html_text import STOP_WORDS

#: Random features, seed, kernel width in standard deviations times the root of the number of statistics.
FEATURES, SEED, WIDTH = 256, 7, 0.7
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1, 1.0)
#: Labelled rows per task when the normal equations are summed; cells of the score axis for calibration.
ROWS_PER_TASK, CELLS = 20_000, 2048
LETTER = re.compile(r"[^\W\d_]")
STOPS = frozenset(w.encode() for w in STOP_WORDS)
SYMBOLS = np.frombuffer(b"$%&*#|@^~_=+<>{}[]\\/", dtype=np.uint8)
STATISTICS = 24


def statistics(text: str) -> list[float]:
    """Numbers that describe a text; all are finite, an empty text gives zeros."""
    data = text.encode("utf-8", "replace")
    n = len(data)
    if not n:
        return [0.0] * STATISTICS
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    low = [w.lower() for w in words]
    lines = [x for x in data.split(b"\n") if x]
    often = Counter(low)
    kinds, total = len(often), max(1, len(words))
    lengths = np.array([len(w) for w in words] or [0])
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    shouted = sum(w.isupper() for w in words)
    ends = counts[46] + counts[33] + counts[63]
    tail = np.array([w[-1] for w in words] or [32])
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean(), lengths.std(),
        counts[48:58].sum() / n, upper / n, upper / max(1, upper + lower), counts[128:].sum() / n,
        counts[SYMBOLS].sum() / n, counts[124] / total, counts[33] / total, ends / total, counts[44] / total,
        sum(w.strip(b".,;:!?$%&*#") in STOPS for w in low) / total, kinds / total, max(often.values(), default=0) / total,
        1 - len(set(lines)) / max(1, len(lines)), max(map(len, lines), default=0) / n, shouted / total,
        np.isin(tail, SYMBOLS).mean(), (lengths <= 2).mean(), (lengths >= 12).mean(),
        sum(n > 1 for n in often.values()) / max(1, kinds),
    ]


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])

    return texts_of(docs).mapInArrow(run, "doc_id long, x array<double>")


class Expansion:
    """Standardised statistics to random Fourier features, with a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.directions = rng.standard_normal((len(mean), FEATURES)) / (WIDTH * np.sqrt(len(mean)))
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -8, 8)
        out = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.hstack([out, np.ones((len(x), 1))])


def isotonic(position: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: positions and the non-decreasing means of total / weight."""
    blocks: list[list[float]] = []
    for p, w, t in sorted(zip(position.tolist(), weight.tolist(), total.tolist())):
        blocks.append([p * w, w, t])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def normal_equations(train: DataFrame, expand: Expansion, tasks: int) -> dict[int, np.ndarray]:
    """Per fold the matrix of summed products of (features, constant, label), from rows of x, y, fold."""
    size = FEATURES + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size, size))
        for batch in slices(batches, 4096):
            y, fold = batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            z = np.hstack([expand(np.array(batch.column("x").to_pylist())), y[:, None]])
            for f in (0, 1):
                sums[f] += z[fold == f].T @ z[fold == f]
        i, j = np.triu_indices(size)
        for f in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), f), pa.int32()), pa.array(i * size + j, pa.int32()), pa.array(sums[f][i, j])],
                ["fold", "cell", "v"])

    cells = train.repartition(tasks).mapInArrow(run, "fold int, cell int, v double").groupBy("fold", "cell").agg(
        F.sum("v").alias("v")).toPandas()
    out = {}
    for f in (0, 1):
        full, mine = np.zeros(size * size), cells[cells["fold"] == f]
        full[mine["cell"].to_numpy()] = mine["v"].to_numpy()
        upper = full.reshape(size, size)
        out[f] = upper + np.triu(upper, 1).T
    return out


def solved(sums: np.ndarray, ridge: float) -> np.ndarray:
    a, b = sums[:-1, :-1], sums[:-1, -1]
    penalty = np.full(len(a), ridge * max(1.0, sums[-2, -2]) / FEATURES)
    penalty[-1] = 1e-9
    return np.linalg.solve(a + np.diag(penalty), b)


def squared_error(sums: np.ndarray, w: np.ndarray) -> float:
    v = np.append(-w, 1.0)
    return float(v @ sums @ v)


def fitted(described_docs: DataFrame, labels: DataFrame, training: Column):
    """A function from statistics to calibrated scores, learned from labelled rows that meet ``training``.

    Labels of one document given several times count by their mean; null labels and rows without statistics are
    left out. Without any label the score is one half.
    """
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).where(
        "doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.avg("y").alias("y"))
    train = stored(described_docs.where(training).join(truth, "doc_id").select(
        "x", "y", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold")), "quality_rows")
    moments = train.select(F.count(F.lit(1)).alias("n"), *[
        f(F.col("x")[k]).alias(f"{name}{k}") for k in range(STATISTICS)
        for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not moments["n"]:
        return lambda x: np.full(len(x), 0.5)
    expand = Expansion(np.array([moments[f"m{k}"] for k in range(STATISTICS)]),
                       np.array([moments[f"s{k}"] for k in range(STATISTICS)]))
    sums = normal_equations(train, expand, max(1, -(-moments["n"] // ROWS_PER_TASK)))
    ridge = min(RIDGES, key=lambda r: sum(squared_error(sums[f], solved(sums[1 - f], r)) for f in (0, 1)))
    halves = [solved(sums[1 - f], ridge) for f in (0, 1)]
    weights = solved(sums[0] + sums[1], ridge)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(CELLS), np.zeros(CELLS)
        for batch in slices(batches, 4096):
            z, fold = expand(np.array(batch.column("x").to_pylist())), batch.column("fold").to_numpy()
            s = np.where(fold == 0, z @ halves[0], z @ halves[1])
            at = np.clip(((s + 0.5) / 2 * CELLS).astype(int), 0, CELLS - 1)
            count += np.bincount(at, minlength=CELLS)
            total += np.bincount(at, weights=batch.column("y").to_numpy(), minlength=CELLS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CELLS)), pa.array(count), pa.array(total)], ["cell", "n", "y"])

    table = train.mapInArrow(cells, "cell long, n double, y double").groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum("y").alias("y")).where("n > 0").toPandas()
    position, value = isotonic((table["cell"].to_numpy() + 0.5) / CELLS * 2 - 0.5, table["n"].to_numpy(), table["y"].to_numpy())

    def score(x: np.ndarray) -> np.ndarray:
        # The calibrated value and a fiftieth of the clipped raw one, which keeps order inside a step.
        raw = expand(x) @ weights
        return np.clip(0.98 * np.interp(raw, position, value) + 0.02 * np.clip(raw, 0, 1), 0, 1)

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """Score (0 to 1, higher: label 1 likelier) of every whole text.

    ``docs``: ``doc_id``, ``text``; ``labels``: ``doc_id``, ``quality``; other columns are ignored.
    ``training`` is a condition on ``doc_id`` that chooses the rows labels are learned from; a null counts as
    not chosen. Result, one row per input row, repeated rows included: ``doc_id``, ``score``. Null and empty
    texts are scored by statistics of zero; an empty table gives an empty result.
    """
    x = stored(described(docs), "statistics")
    score = fitted(x, labels, training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            values = score(np.array(batch.column("x").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    return x.mapInArrow(run, "doc_id long, score double")
