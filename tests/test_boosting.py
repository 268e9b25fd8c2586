"""Boosted trees: against a plain trainer that tries every split, and against themselves grown in other ways."""

from dataclasses import replace

import numpy as np
import pytest

from kerbcast.models import boosting
from kerbcast.models.boosting import Boosted, Fit, fit_all


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 900
    a, b = rng.integers(0, 12, n).astype(float), rng.normal(size=n).round(2)
    c = np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 4, n))
    y = np.where(a > 6, 5.0, 1.0) + b * 2 + np.where(np.isnan(c), 3, c) + rng.normal(size=n).round(3)
    w = rng.integers(1, 4, n) / 2
    rows = [(float(p), float(q), None if np.isnan(r) else float(r), float(s), float(t), i)
            for i, (p, q, r, s, t) in enumerate(zip(a, b, c, y, w))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, w double, id int").repartition(5).cache()
    return np.column_stack([a, b, c]), y, w, df


def plain(x, y, w, spec, cuts):
    """Predictions of trees grown with lists and loops: every cut of every feature, both ways for missing values."""
    base = float(np.sum(y * w) / np.sum(w))
    margin = np.full(len(y), base)

    def grown(rows, g, h, level):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        score = lambda p, q: p * p / (q + spec.penalty)
        best = (1e-6, None)
        if level < spec.depth:
            for missing_left in (False, True):
                for f in range(x.shape[1]):
                    gap = np.isnan(x[rows, f])
                    for cut in [*cuts[f], np.inf]:
                        left = np.where(gap, missing_left, x[rows, f] < cut)
                        lg, lh = g[rows][left].sum(), h[rows][left].sum()
                        if min(lh, total_h - lh) < spec.least_weight:
                            continue
                        gain = score(lg, lh) + score(total_g - lg, total_h - lh) - score(total_g, total_h)
                        if gain > best[0] + 1e-7:
                            best = (gain, left)
        if best[1] is None:
            return {int(r): -spec.rate * total_g / (total_h + spec.penalty) for r in rows}
        return grown(rows[best[1]], g, h, level + 1) | grown(rows[~best[1]], g, h, level + 1)

    for _ in range(spec.trees):
        values = grown(np.arange(len(y)), w * (margin - y), w, 0)
        margin = margin + np.array([values[i] for i in range(len(y))])
    return margin


def predictions(model, df):
    rows = model.transform(df).select("id", "_prediction").collect()
    return np.array([r[1] for r in sorted(rows)])


@pytest.mark.parametrize("bins, weight", [(256, "w"), (8, None)])
def test_equals_a_plain_trainer(table, bins, weight):
    x, y, w, df = table
    spec = Boosted(trees=4, depth=4, rate=0.3, bins=bins)
    model = fit_all([Fit(df, ("a", "b", "c"), "y", weight)], spec)[0]
    assert [len(c) + 1 <= bins for c in model.cuts] == [True] * 3 and len(model.cuts[2]) == 3
    assert len(model.cuts[0]) == (11 if bins > 12 else 7)
    expected = plain(x, y, w if weight else np.ones(len(y)), spec, model.cuts)
    assert predictions(model, df) == pytest.approx(expected, abs=1e-6)


def test_all_ways_of_growing_give_equal_trees(table, spark, monkeypatch):
    _, _, _, df = table
    monkeypatch.setattr(boosting, "REWRITE_EVERY", 2)
    fits = [Fit(df, ("a", "b", "c"), "y", "w"), Fit(df.where("id % 3 != 0"), ("b", "a"), "y"),
            Fit(df.where("id < 40"), ("a",), "y", log_target=False)]
    whole = fit_all(fits, Boosted(trees=3, depth=4, rate=0.3))
    for rows in (300, 60):  # levels over all tasks first, then subtrees; the last fit in one task
        spread = fit_all(fits, Boosted(trees=3, depth=4, rate=0.3, task_rows=rows))
        for one, other in zip(whole, spread):
            assert one.base == other.base and len(one.trees) == len(other.trees) == 3
            for p, q in zip(one.trees, other.trees):
                assert np.array_equal(np.sort(p, order="id"), np.sort(q, order="id"))
    by_levels = fit_all(fits[:1], Boosted(trees=2, depth=2, task_rows=1))[0]
    again = fit_all([Fit(df.repartition(2), ("a", "b", "c"), "y", "w")], Boosted(trees=2, depth=2))[0]
    for p, q in zip(by_levels.trees, again.trees):
        assert np.array_equal(np.sort(p, order="id"), np.sort(q, order="id"))


def test_defined_results_without_rows_or_values(table, spark):
    _, _, _, df = table
    none, flat, blank = fit_all([
        Fit(df.where("false"), ("a", "b"), "y"), Fit(df.selectExpr("id", "a", "2.0 as y"), ("a",), "y"),
        Fit(df.selectExpr("id", "cast(null as double) as a", "y"), ("a",), "y")], Boosted(trees=2, depth=3))
    assert set(predictions(none, df)) == {0.0}
    assert predictions(flat, df) == pytest.approx(2.0)
    assert len(set(predictions(blank, df.drop("a").selectExpr("id", "cast(null as double) as a")))) == 1
    assert sum(fit_all([Fit(df, ("a", "b"), "y")], Boosted(trees=2, depth=3))[0].gains()) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        Boosted(task_rows=0)


def test_null_targets_and_weights_are_left_out(table, spark):
    _, _, _, df = table
    extra = df.selectExpr("a", "b", "c", "cast(null as double) as y", "w", "id").unionByName(df.selectExpr(
        "a", "b", "c", "y", "cast(0 as double) as w", "id"))
    spec = Boosted(trees=2, depth=3)
    one, two = (fit_all([Fit(rows, ("a", "b", "c"), "y", "w")], spec)[0] for rows in (df, df.unionByName(extra)))
    assert one.base == two.base and all(np.array_equal(p, q) for p, q in zip(one.trees, two.trees))


def test_trees_of_large_fits_take_few_jobs(table, spark, monkeypatch):
    # A level is one job, whose sums come directly or through a shuffle; a tree's margins are made once, not per level.
    _, _, _, df = table
    monkeypatch.setattr(boosting, "REWRITE_EVERY", 3)
    fits, context = [Fit(df, ("a", "b", "c"), "y", "w"), Fit(df.where("id % 3 != 0"), ("b", "a"), "y")], spark.sparkContext
    found, jobs = [], []
    for trees, direct in ((2, 1 << 24), (8, 1 << 24), (8, 0)):
        monkeypatch.setattr(boosting, "DIRECT_BYTES", direct, raising=False)
        context.setJobGroup(f"few-jobs-{trees}-{direct}", "")
        found.append(fit_all(fits, Boosted(trees=trees, depth=3, rate=0.3, task_rows=60)))
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"few-jobs-{trees}-{direct}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    # Three levels at most and one for the subtrees, six times; two writes of margins.
    assert jobs[1] - jobs[0] <= 6 * 4 + 2 * 2 and abs(jobs[2] - jobs[1]) <= 2
    for one, other in zip(found[1], found[2]):
        assert all(np.array_equal(np.sort(p, order="id"), np.sort(q, order="id")) for p, q in zip(one.trees, other.trees))


def test_walking_all_rows_at_once_ends_in_the_right_leaves():
    rng = np.random.default_rng(8)
    layout = boosting.Layout((9, 4), True)
    bins = np.stack([rng.integers(0, 10, 500), rng.integers(0, 5, 500)], axis=1).astype(np.int16)
    setting = boosting.Setting(layout, 0.0, 30, 30, 500)
    g, h = boosting.gradients(setting, np.zeros(500), bins[:, 0] * 1.0 + (bins[:, 1] == 4) * 7, np.ones(500))
    nodes, value = boosting.grow(setting, Boosted(depth=5), bins, g, h, 5, 2)
    tree = boosting.Tree(nodes)
    by_id = {int(n["id"]): n for n in nodes}
    for row, leaf, v in zip(bins.tolist(), tree.leaves(layout, bins), value):
        node = by_id[5]
        while node["feature"] >= 0:
            x = row[node["feature"]]
            left = node["missing_left"] if x == layout.sizes[node["feature"]] else x <= node["bin"]
            node = by_id[2 * int(node["id"]) + (not left)]
        assert tree.nodes["id"][leaf] == node["id"] and v == node["value"]


def test_sums_of_packed_features_equal_plain_ones():
    rng = np.random.default_rng(4)
    layout = boosting.Layout((256, 4, 90, 2999, 10), True)
    assert sorted(f for pack in layout.packs for f in pack) == [0, 1, 2, 3, 4] and max(map(len, layout.packs)) > 1
    bins = np.stack([rng.integers(0, k + 1, 700) for k in layout.sizes], axis=1).astype(np.int16)
    place, g = rng.integers(0, 3, 700), rng.integers(-2**40, 2**40, 700).astype(float)
    sums, rows = boosting.histograms(layout, bins, place, 3, g, None)
    want_sums, want_rows = np.zeros((3, layout.width)), np.zeros((3, layout.width))
    for f, start in enumerate(layout.starts[:-1]):
        np.add.at(want_sums, (place, start + bins[:, f]), g)
        np.add.at(want_rows, (place, start + bins[:, f]), 1)
    assert np.array_equal(sums, want_sums) and np.array_equal(rows, want_rows)


def test_blocks_of_uneven_files_are_dealt_evenly_and_carry_no_equal_weights(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    parts = [(i, np.zeros(2, "<i2").tobytes(), float(i), 0.5, 0.0) for i in range(1600)]
    uneven = spark.sparkContext.parallelize(parts, 1).toDF("fit int, bins binary, y double, w double, margin double")
    setting = boosting.Setting(boosting.Layout((4, 4), False), 0.0, 20, 20, 1600, 0.5)
    shared = spark.sparkContext.broadcast([setting] * 1600)
    blocks = boosting._blocks(uneven.selectExpr("0 as fit", "bins", "y", "w", "margin"), shared).glom().collect()
    held = [sum(len(b[2]) for b in part) for part in blocks]
    assert sum(held) == 1600 and len(held) >= 8 and max(held) - min(held) <= 50
    assert sorted(y for part in blocks for b in part for y in b[2]) == list(range(1600))
    assert all(b[3] is None for part in blocks for b in part)


def test_equal_weights_grow_the_trees_of_listed_ones(table, monkeypatch):
    _, _, _, df = table
    spec, fit = Boosted(trees=3, depth=4, rate=0.3, task_rows=60), Fit(df.selectExpr("a", "b", "c", "y", "0.5 as w"), ("a", "b", "c"), "y", "w")
    one = fit_all([fit], spec)[0]
    known = boosting._settings
    monkeypatch.setattr(boosting, "_settings", lambda *a: [replace(s, weight=None) for s in known(*a)])
    other = fit_all([fit], spec)[0]
    assert one.base == other.base
    for p, q in zip(one.trees, other.trees):
        assert np.array_equal(np.sort(p, order="id"), np.sort(q, order="id"))
