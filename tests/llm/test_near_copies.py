import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kerbcast.llm import near_copies
from kerbcast.llm.links import components
from kerbcast.llm.near_copies import near_groups, rest_pairs, shared_halves, sides, without_near_copies


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_force(rows, n, percent):
    """Smallest id reachable of each named row, by comparing all pairs."""
    sets = defaultdict(set)
    for d, t in rows:
        sets[d].add(shingles(t, n))
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        for x in sets[a]:
            for y in sets[b]:
                if x and y and 100 * len(x & y) >= percent * len(x | y):
                    parent[max(top(a), top(b))] = min(top(a), top(b))
    return {d: top(d) for d in sets}


def changed(text, count, rng):
    words = text.split()
    for i in rng.sample(range(len(words)), count):
        words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_groups_equal_all_pairs(documents, prose, n, percent):
    rng = random.Random(n)
    rows = [(i, prose(i, rng.randrange(1, 200))) for i in range(60)]
    base = prose(1000, 150)
    # One crowd around a text with growing numbers of changes, chains of edits, and a shared passage.
    rows += [(100 + i, changed(base, rng.randrange(0, 9), rng)) for i in range(80)]
    link = prose(2000, 120)
    for i in range(25):
        link = changed(link, 2, rng)
        rows.append((300 + i, link))
    rows += [(400 + i, f"{prose(3000, 60)} {prose(3001 + i, 40)}") for i in range(20)]
    rng.shuffle(rows)
    want = brute_force(rows, n, percent)
    got = near_groups(documents(rows), n, percent).collect()
    assert len(got) == len(rows)
    sizes = {d: len(shingles(t, n)) for d, t in rows}
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], want[r.doc_id], r.doc_id == want[r.doc_id])


def test_awkward_rows(documents, odd):
    rows = [*odd, (20, "one"), (19, "ONE"), (21, "one two"), (22, "one two")]
    got = near_groups(documents(rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [(r.component_id, r.kept, r.n_shingles) for d in (1, 2, 3) for r in by[d]] == [(d, True, 0) for d in (1, 2, 3)]
    assert by[None][0].component_id == 4 and not by[None][0].kept
    assert by[20][0].component_id == 19 and by[22][0].component_id == 21
    assert [r.component_id for r in by[5]] == [5, 5]


def test_one_document_of_each_group_stays(documents):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    docs = documents([(7, text), (3, text.upper()), (9, text + " more"), (1, "other words only here"), (2, None)])
    out = without_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 3]


def test_empty_table(documents):
    empty = documents([(1, "x")]).limit(0)
    assert near_groups(empty).count() == 0 and without_near_copies(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def test_half_keys_meet_the_limit():
    for percent in (80, 85, 95):
        s, share = sides(percent), (percent / 100) ** 3
        assert (1 - share) ** s <= 5e-4 < (1 - share) ** (s - 1)


def test_rows_without_ids(documents):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "uno dos tres cuatro cinco seis")
    rows = [(4, a), (None, a), (None, b), (5, c), (None, b), (None, b.upper()), (None, None), (None, ""), (6, c)]
    out = without_near_copies(documents(rows))
    got = sorted((r.doc_id or 0, (r.text or "").lower()) for r in out.collect())
    assert got == sorted([(4, a), (0, b), (5, c), (0, ""), (0, "")])


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_rest_pairs_lose_none(spark, percent):
    rng = random.Random(percent)
    rows = []
    for node in range(250):
        n, component = rng.randrange(5, 60), rng.randrange(250) if rng.random() < 0.6 else 7
        for shingle in rng.sample(range(6), 2):
            rows.append((shingle, node, component, n, rng.randrange(1, max(2, n * (100 - percent) // 100 + 2))))
    prefix = spark.createDataFrame(rows, "shingle long, node long, component long, n long, place long")
    got = [(r.a, r.b) for r in rest_pairs(prefix, percent).collect()]
    want = set()
    for s, x, c, n, p in rows:
        for t, y, d, m, q in rows:
            if s == t and x < y and c != d and 100 * min(n, m) >= percent * max(n, m):
                if (1 + min(n - p, m - q)) * (100 + percent) >= percent * (n + m):
                    want.add((x, y))
    assert len(got) == len(set(got)) and set(got) == want


def test_a_crowd_with_one_late_shingle_is_not_paired(spark):
    # One template: the shingle stands behind 14 others of 100 in each of the sets.
    rows = [(1, node, node, 95 + node % 11, 15) for node in range(2000)]
    prefix = spark.createDataFrame(rows, "shingle long, node long, component long, n long, place long")
    assert rest_pairs(prefix, 85).count() == 0


def test_only_shared_half_keys_are_combined(spark):
    rng = random.Random(4)
    side, rows = 3, [[i, 10, i, [rng.randrange(40 if i < 30 else 10**15) for _ in range(6)]] for i in range(200)]
    classes = spark.createDataFrame(rows, "node long, n long, name1 long, half_keys array<long>")
    got = {r.node: (len(r.lefts), len(r.rights)) for r in shared_halves(classes, side).collect()}
    at = [defaultdict(int) for _ in range(6)]
    for *_, keys in rows:
        for i, k in enumerate(keys):
            at[i][k] += 1
    want = {d: tuple(sum(at[i][keys[i]] > 1 for i in r) for r in (range(3), range(3, 6))) for d, _, _, keys in rows}
    assert got == {d: w for d, w in want.items() if any(w)} and len(got) <= 30


def test_rows_that_stay_are_not_looked_up(spark, monkeypatch):
    rows = spark.range(-3000, 17_000).select(F.col("id").alias("doc_id"), F.lit("entry").alias("entry"))
    rows = rows.unionByName(rows.where("doc_id % 1000 = 7"))
    ids = spark.createDataFrame([(i,) for i in range(-3000, 17_000, 20)] + [(10**12,)], "doc_id long")
    want = sorted(r.doc_id for r in rows.where("pmod(doc_id, 20) <> 0").collect())
    for bits in (16, 160):  # one bitmap, then several
        monkeypatch.setattr(near_copies, "BITS_AN_ID", bits)
        marked = near_copies.marked_by_bitmaps(rows, ids)
        assert marked.where("NOT asked AND pmod(doc_id, 20) = 0").isEmpty()
        assert marked.where("asked").count() < 3000
        left = near_copies.without_ids(rows, ids)
        assert left.columns == rows.columns and sorted(r.doc_id for r in left.collect()) == want
    assert near_copies.without_ids(rows, ids.limit(0)).count() == rows.count()
