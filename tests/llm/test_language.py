import itertools
import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from kerbcast.llm.language import Field, chain_expectations, fitted, in_language, label_marginals, languages, summed, word_features

SYLLABLES = {"aa": ["tion", "the", "er", "ing"], "bb": ["eau", "oui", "que", "ç"], "cc": ["ung", "sch", "ß", "ver"]}


def text(lang, seed, n=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    sizes, k = [1, 4, 2, 5], 3
    emission, start, step = rng.standard_normal((sum(sizes), k)), rng.standard_normal(k), rng.standard_normal((k, k))
    want, at = [], 0
    for n in sizes:
        total = np.zeros((n, k))
        for labels in itertools.product(range(k), repeat=n):
            s = start[labels[0]] + sum(emission[at + i, y] for i, y in enumerate(labels)) + sum(step[a, b] for a, b in zip(labels, labels[1:]))
            for i, y in enumerate(labels):
                total[i, y] += np.exp(s)
        want.append(total / total.sum(axis=1, keepdims=True))
        at += n
    first = np.zeros(sum(sizes), dtype=bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    assert np.allclose(label_marginals(emission, first, start, step), np.concatenate(want))


def test_expected_changes_equal_enumeration():
    rng = np.random.default_rng(8)
    emission, start, step = 2 * rng.standard_normal((5, 6, 3)), rng.standard_normal(3), 2 * rng.standard_normal((3, 3))
    changes = np.zeros((3, 3))
    for chain in emission:
        total, found = 0.0, np.zeros((3, 3))
        for labels in itertools.product(range(3), repeat=6):
            pairs = list(zip(labels, labels[1:]))
            p = np.exp(start[labels[0]] + sum(chain[i, y] for i, y in enumerate(labels)) + sum(step[a, b] for a, b in pairs))
            total += p
            for a, b in pairs:
                found[a, b] += p
        changes += found / total
    marginal, expected = chain_expectations(emission, start, step)
    assert np.allclose(expected, changes)
    first = np.tile(np.arange(6) == 0, 5)
    assert np.allclose(marginal.reshape(30, 3), label_marginals(emission.reshape(30, 3), first, start, step))
    alone, none = chain_expectations(emission[:, :1], start, step)
    assert np.allclose(alone.sum(axis=2), 1) and not none.any()


def test_long_chains_cross_columns():
    rng = np.random.default_rng(4)
    emission, start, step = rng.standard_normal((1000, 2)), np.zeros(2), np.array([[2.0, 0], [0, 2]])
    first = np.zeros(1000, dtype=bool)
    first[[0, 300, 301]] = True
    whole = label_marginals(emission, first, start, step)
    for a, b in ((0, 300), (300, 301), (301, 1000)):
        alone = np.zeros(b - a, dtype=bool)
        alone[0] = True
        assert np.allclose(whole[a:b], label_marginals(emission[a:b], alone, start, step))


def test_words_of_mixed_texts_get_their_own_language():
    field = Field(sorted(SYLLABLES)).fit([(text(lang, i), lang) for lang in SYLLABLES for i in range(60)])
    one, other = text("aa", 900, 30), text("bb", 901, 20)
    names, scores = field.predict([f"{one} {other}", other, "12 !!", ""])
    assert names == ["aa", "bb", "und", "und"] and scores[2:] == [0.0, 0.0]
    assert 0.5 < scores[0] < 0.7 < 0.9 < scores[1]


def test_many_new_words_are_scored_in_bounded_memory():
    field = Field(["aa", "bb"])
    field.weights = np.random.default_rng(5).standard_normal(field.weights.shape).astype(np.float32)
    words = [f"{i:x}{text('aa', i, 1)}" for i in range(60_000)]
    want = summed(field.weights, *word_features(words)).astype(np.float32)
    tracemalloc.start()
    got = field.scores(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, want)
    assert peak < 40e6


def test_held_out_accuracy_and_awkward_rows(documents, odd):
    rows = [(1000 + i, text(lang, i), lang) for i, lang in enumerate(sorted(SYLLABLES) * 60)]
    docs = documents([*odd, *rows, (9000, text("cc", 1), None)])
    learn = F.col("doc_id") % 4 != 1
    got = {r.doc_id: r for r in languages(docs, learn).collect()}
    held = [r for r in rows if r[0] % 4 == 1]
    assert sum(got[d].lang_pred == lang for d, _, lang in held) == len(held)
    assert [got[d].lang_pred for d in (1, 2, 3, 7)] == ["und"] * 4
    assert languages(docs, learn).count() == len(odd) + len(rows) + 1
    kept = in_language(docs, learn)
    assert kept.columns == docs.columns
    assert kept.count() == len(odd) - 4 + len(rows) + 1


def test_rare_languages_are_learned(documents):
    rows = [(i, text("aa", i), "aa") for i in range(400)] + [(None, text("bb", 0), "bb")]
    rows += [(1000 + i, text("cc", i), "cc") for i in range(4)] + [(2000, text("cc", 5), None)]
    docs = documents(rows)
    # The four rows of "cc" are not among the three smallest hashes, nor is the row without an id.
    assert fitted(docs, F.lit(True), sample_rows=3).labels == ["aa", "bb", "cc"]
    got = {r.doc_id: r.lang_pred for r in languages(docs, F.lit(True), sample_rows=3).collect()}
    assert got[2000] == "cc" and got[7] == "aa"


def test_nothing_to_learn_from(documents):
    docs = documents([(1, "some words", None), (2, "more words", None)])
    assert {r.lang_pred for r in languages(docs, F.lit(True)).collect()} == {"und"}
    assert languages(docs.limit(0), F.lit(True)).count() == 0
