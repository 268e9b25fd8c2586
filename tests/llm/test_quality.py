import random

import numpy as np
from pyspark.sql import functions as F

from kerbcast.llm.quality import CELLS, FEATURES, RIDGES, STATISTICS, WIDTH, Expansion, isotonic, quality_scores, statistics


def junk(text, seed):
    rng = random.Random(seed)
    return " ".join(w + rng.choice(["$$$", "%%%", "###"]) for w in text.split())


def test_statistics_are_finite(odd):
    for _, t in odd:
        values = statistics(t or "")
        assert len(values) == STATISTICS and np.isfinite(values).all()


def test_isotonic_pools_violators():
    x, y = isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 1, 1, 1]), np.array([0.0, 1, 0, 1]))
    assert y.tolist() == [0, 0.5, 1] and x.tolist() == [1, 2.5, 4]


def test_held_out_scores(spark, documents, prose, odd):
    rows = []
    for i in range(300):
        text = prose(i, 20 + i % 50)
        rows.append((100 + i, junk(text, i) if i % 4 == 0 else text))
    labels = [(d, int((d - 100) % 4 != 0), "x") for d, _ in rows if d % 5] + [(101, None, "x"), (None, 1, "x")]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    docs = documents([*odd, *rows])
    got = quality_scores(docs, labels, F.col("doc_id") % 3 != 1).collect()
    assert len(got) == len(odd) + len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [(r.score, (r.doc_id - 100) % 4 != 0) for r in got if (r.doc_id or 0) >= 100 and r.doc_id % 3 == 1]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.97
    assert quality_scores(docs.limit(0), labels, F.lit(True)).count() == 0
    assert {r.score for r in quality_scores(docs, labels.limit(0), F.lit(True)).collect()} == {0.5}


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, STATISTICS))
    z = Expansion(np.zeros(STATISTICS), np.ones(STATISTICS))(x)[:, :-1]
    squared = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    kernel = np.exp(-squared / (2 * WIDTH ** 2 * STATISTICS))
    assert np.abs(z @ z.T - kernel).mean() < 0.08 and np.abs(z @ z.T - kernel).max() < 0.4


def test_scores_equal_a_plain_fit(spark, documents, prose):
    rows = [(d, junk(prose(d, 15 + d % 40), d) if d % 4 == 0 else prose(d, 15 + d % 40)) for d in range(400)]
    truth = {d: float(d % 4 != 0 if d % 11 else d % 4 == 0) for d, _ in rows if d % 3 != 1 and d % 7}
    labels = spark.createDataFrame([(d, int(y)) for d, y in truth.items()], "doc_id long, quality int")
    docs = documents(rows)
    got = {r.doc_id: r.score for r in quality_scores(docs, labels, F.col("doc_id") % 3 != 1).collect()}
    fold = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("f")).collect()}

    x = {d: np.array(statistics(t)) for d, t in rows}
    train = sorted(truth)
    a = np.array([x[d] for d in train])
    expand = Expansion(a.mean(axis=0), a.std(axis=0))
    z, y, half = expand(a), np.array([truth[d] for d in train]), np.array([fold[d] for d in train])

    def fit(rows_, ridge):
        # Least squares with the penalty as extra rows.
        weight = np.append(np.full(FEATURES, ridge * max(1, rows_.sum()) / FEATURES), 1e-9)
        return np.linalg.lstsq(np.vstack([z[rows_], np.diag(np.sqrt(weight))]), np.append(y[rows_], np.zeros(FEATURES + 1)), rcond=None)[0]

    def outside(ridge):
        return np.where(half == 0, z @ fit(half == 1, ridge), z @ fit(half == 0, ridge))

    ridge = min(RIDGES, key=lambda r: ((outside(r) - y) ** 2).sum())
    cell = np.clip(((outside(ridge) + 0.5) / 2 * CELLS).astype(int), 0, CELLS - 1)
    place, n = np.unique(cell, return_counts=True)
    total = np.array([y[cell == c].sum() for c in place])
    # The monotone fit by its formula: the largest over starts of the smallest over ends of the mean between.
    mean = np.array([max(min(total[i:j + 1].sum() / n[i:j + 1].sum() for j in range(k, len(n))) for i in range(k + 1))
                     for k in range(len(n))])
    at = (place + 0.5) / CELLS * 2 - 0.5
    value, inverse = np.unique(mean.round(12), return_inverse=True)
    centre = np.array([(at * n)[inverse == k].sum() / n[inverse == k].sum() for k in range(len(value))])
    weights = fit(np.ones(len(y), dtype=bool), ridge)
    for d, _ in rows:
        raw = float((expand(x[d][None]) @ weights)[0])
        want = np.clip(0.98 * np.interp(raw, centre, value) + 0.02 * np.clip(raw, 0, 1), 0, 1)
        assert abs(got[d] - want) < 1e-4
