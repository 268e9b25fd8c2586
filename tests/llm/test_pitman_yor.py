import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kerbcast.llm.pitman_yor import (
    CONTEXTS, Seating, WordSeating, bucket_count, endings, get, pairs_of, put, scored, seated, totals_of, word_numbers,
)


def base_scores(rows, learn):
    words = [(d, (t or "").encode().lower().split() + [b""]) for d, t in rows]
    counts = Counter(w for d, ws in words if learn(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return n, {d: (len(ws), sum(counts[w] > 0 for w in ws), sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
               for d, ws in words}


def test_base_is_exact_and_model_is_better(documents, odd, prose):
    rows = [*odd, *[(100 + i, f"le {prose(i, 60)}." if i % 2 else f"the {prose(i, 60)} end") for i in range(150)]]
    got = scored(documents(rows), F.col("doc_id") % 5 != 1).collect()
    assert len(got) == len(rows)
    tokens, want = base_scores(rows, lambda d: d is not None and d % 5 != 1)
    for r in got:
        n, known, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score <= 0
    held = [r for r in got if (r.doc_id or 0) >= 100 and r.doc_id % 5 == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_many_short_texts(documents):
    rows = [(i, f"w{i % 7} w{i % 11}") for i in range(3000)]
    docs = documents(rows).coalesce(1)
    got = {r.doc_id: r for r in scored(docs, F.col("doc_id") % 5 != 1).collect()}
    tokens, want = base_scores(rows, lambda d: d % 5 != 1)
    assert len(got) == 3000
    assert all((got[d].n_tokens, got[d].n_known) == w[:2] and math.isclose(got[d].base_score, w[2], rel_tol=1e-9) for d, w in want.items())
    assert all(-8 < r.score < 0 for r in got.values())


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 6, 40)
    context = np.concatenate([np.sort(rng.choice(9, n, replace=False)) for n in lengths])
    customers = rng.integers(0, 200, len(context))
    seating = Seating(lengths, context, customers, 1)
    totals = totals_of(seating.sums())
    for k in range(3):
        seating.sweep(totals, k)
        totals = totals_of(seating.sums())
        assert (seating.tables <= seating.customers).all() and (seating.tables >= 1).all()
        assert totals.tables.sum() == seating.root_customers.sum()
        root = totals.root_probability(seating.root_customers, seating.root_tables)
        unknown = totals.root_probability(np.zeros(1), np.zeros(1))[0]
        missing = (seating.counts == 0).sum()
        assert math.isclose(root[seating.counts > 0].sum() + unknown, 1, rel_tol=1e-9)
        for c in range(9):
            here = seating.context == c
            n = np.zeros(len(lengths))
            t = np.zeros(len(lengths))
            n[seating.word[here]], t[seating.word[here]] = seating.customers[here], seating.tables[here]
            p = totals.probability(np.full(len(lengths), c), n, t, root)
            rest = totals.probability(np.array([c]), np.zeros(1), np.zeros(1), np.array([unknown]))[0]
            assert math.isclose(p.sum() - missing * rest + rest, 1, rel_tol=1e-9)


def test_tables_follow_the_restaurant_process():
    # Expected tables of one dish with certain parent draw: theta and discount alone decide.
    rng = np.random.default_rng(1)
    t = seated(np.full(4000, 30.0), np.zeros(4000), np.ones(4000), 0.5, rng).mean()
    expected = 1.0
    for n in range(1, 30):
        expected += (1 + 0.5 * expected) / (1 + n)
    assert abs(t - expected) < 0.15
    large = seated(np.full(300, 5000.0), np.zeros(300), np.ones(300), 0.5, rng).mean()
    exact = 1.0
    for n in range(1, 5000):
        exact += (1 + 0.5 * exact) / (1 + n)
    assert abs(large / exact - 1) < 0.05


def test_packed_arrays():
    for a in (np.array([], np.int64), np.array([0, 255]), np.array([70_000]), np.array([2**63], np.uint64), np.array([1.5, -2])):
        assert (get(put(a)) == a).all() and len(get(put(a))) == len(a)


def test_nothing_to_learn_from(documents):
    docs = documents([(1, "some words"), (2, None)])
    got = {r.doc_id: r for r in scored(docs, F.lit(False)).collect()}
    assert got[1].n_known == 0 and got[1].train_tokens == 0 and abs(got[1].score) < 1e-6 and got[1].base_score == 0
    assert scored(docs.limit(0), F.lit(True)).count() == 0
    assert CONTEXTS > 1


def test_buckets_follow_the_bytes_of_texts(documents, prose):
    docs = documents([(i, prose(i, 200)) for i in range(60)] + [(60, None), (61, "é" * 100)])
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert bucket_count(docs) == 8 and bucket_count(docs.limit(0)) == 8
    assert bucket_count(docs, 1000) == -(-size // 1000)
    # How many buckets there are changes the draws, not the counts.
    few, many = ({r.doc_id: r for r in scored(docs, F.col("doc_id") % 5 != 1, bucket_bytes=b).collect()} for b in (10**9, 1000))
    assert few.keys() == many.keys()
    for d, r in few.items():
        other = many[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (other.n_tokens, other.n_known, other.train_tokens)
        assert math.isclose(r.base_score, other.base_score, rel_tol=1e-9)
        assert math.isclose(r.score, other.score, rel_tol=0.05)


def test_every_ending_is_a_context_of_its_own(documents):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"{a}{b}{c}".encode() for a in letters for b in letters for c in letters]
    words += [w[1:] for w in words[:676]] + [w[2:] for w in words[:26]] + ["é".encode(), "日".encode(), b"\x00", b"\x00\x00"]
    assert len(set(endings(words).tolist())) == len(words)
    assert (endings([b"x" + w for w in words if len(w) == 3]) == endings([w for w in words if len(w) == 3])).all()
    assert 0 < endings(words).min() and endings(words).max() < CONTEXTS and endings([b""]).tolist() == [0]
    # Each of 6,000 words is followed by one word only: with a context for each that word is all but certain.
    pairs = [(words[i].decode(), f"then{words[i].decode()}z") for i in range(6000)]
    rows = [(5 * i, " ".join(f"{a} {b}" for a, b in pairs[i::60] for _ in range(20))) for i in range(60)]
    rows += [(1, pairs[0][0] + " " + pairs[0][1]), (6, pairs[0][0] + " " + pairs[1][1])]
    got = {r.doc_id: r.score for r in scored(documents(rows), F.col("doc_id") % 5 != 1).collect()}
    assert got[1] > got[6] + 3


def test_every_preceding_word_is_a_context_of_its_own(documents):
    # 300 words with one ending, each followed by one word only: endings alone cannot tell which.
    pairs = [(f"w{i}ing", f"then{i}z") for i in range(300)]
    rows = [(5 * i, " ".join(f"{a} {b}" for a, b in pairs[i::30] for _ in range(20))) for i in range(30)]
    rows += [(1, f"{pairs[0][0]} {pairs[0][1]}"), (6, f"{pairs[0][0]} {pairs[1][1]}"), (11, f"newing {pairs[1][1]}"),
             (16, f"newxyz {pairs[1][1]}")]
    for size in (10**9, 200):  # few buckets without frequent words, and many buckets with some
        got = {r.doc_id: r.score for r in scored(documents(rows), F.col("doc_id") % 5 != 1, bucket_bytes=size).collect()}
        assert got[1] > got[6] + 1.5
        # A word that training does not have backs off to its ending, and one with an unknown ending to all words.
        assert got[11] > got[16]


def test_probabilities_after_words_sum_to_one():
    rng = np.random.default_rng(2)
    words, contexts = 30, 12
    ending_of = np.sort(rng.integers(0, 4, contexts))
    pairs = [np.sort(rng.choice(contexts, rng.integers(2, 9), replace=False)) for _ in range(words)]
    ending = [np.unique(ending_of[p], return_counts=True) for p in pairs]
    context = np.concatenate(pairs)
    customers = rng.integers(0, 60, len(context))
    lengths, sizes = np.array([len(e) for e, _ in ending]), np.concatenate([n for _, n in ending])
    seating = WordSeating(lengths, np.concatenate([e for e, _ in ending]), sizes, context, customers, 3)
    own = np.bincount(context, weights=customers, minlength=contexts)
    word = np.repeat(np.arange(words), [len(p) for p in pairs])
    totals = totals_of(seating.sums(0))
    for k in range(4):
        there = np.bincount(context, weights=seating.tables, minlength=contexts)
        assert totals.customers.sum() == seating.tables.sum() and totals.tables.sum() == seating.below.root_customers.sum()
        assert (seating.tables <= customers).all() and (seating.below.tables <= seating.below.customers).all()
        root = seating.below.root(totals)
        unknown = totals.root_probability(np.zeros(1), np.zeros(1))
        p = seating.probability(totals, there, own)
        of_ending = {(w, e): x for w, e, x in zip(seating.word, seating.ending, seating.endings(totals))}
        for u in range(contexts):
            e, sum_ = ending_of[u], 0.0
            back = (1.0 + totals.word_discount * there[u]) / (1.0 + own[u])
            none = totals.probability(np.array([e]), np.zeros(1), np.zeros(1), np.ones(1))[0]
            for w in np.flatnonzero(seating.counts > 0):
                here = p[(word == w) & (context == u)]
                sum_ += here[0] if len(here) else back * of_ending.get((w, e), none * root[w])
            assert math.isclose(sum_ + back * none * unknown[0], 1, rel_tol=1e-9)
        # Written and read again, the seating is the same.
        again = WordSeating(lengths, seating.ending, sizes, context, customers, 3)
        again.take(seating.put())
        assert (again.probability(totals, there, own) == p).all()
        seating.sweep(totals, k, there)
        totals = totals_of(seating.sums(0), totals, k)


def test_pairs_of_a_batch_are_whole():
    texts = ["a b a b", "", "b a\tB", "ping thing ping"]
    heavy = np.sort(word_numbers([b"b"]))
    found = pairs_of(texts, np.array([1, 1, 0, 1]), 4, heavy)
    assert found.tokens.tolist() == [5, 1, 4, 4] and found.times.sum() == 14 and found.sizes.sum() == len(found.pair)
    want = Counter()
    for text, learn in zip(texts, (1, 1, 0, 1)):
        words = text.lower().encode().split() + [b""]
        for before, word in zip([b"", *words], words):
            want[before, word] += learn
    assert len(found.word) == len(want) and sorted(found.customers) == sorted(want.values())
    assert (np.diff(found.home) >= 0).all() and (found.home < 4).sum() == sum(word == b"b" for _, word in want)
