import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kerbcast.llm import divergence


def brute(rows, least=3, top=200):
    """The audit with dictionaries and Python integers."""
    words = [(lang or "", source or "", [
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
        for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in rows]
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, found in words:
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)

        def p_of(count):
            whole = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // whole for t in kept}

        q = p_of(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: p_of(counts[lang, s]) for s in sources}
        for s in sources:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)
                        if part == "pair" or i <= top]
    return sorted(out)


@pytest.fixture(scope="module")
def rows(odd, prose):
    texts = [(("en", "fr", None)[i % 3], ("a", "b", None, "é", "a")[i % 5], prose(i % 40, 30 + i)) for i in range(120)]
    return [*[("odd", f"s{i % 3}", t) for i, (_, t) in enumerate(odd)], *texts, ("en", "only punctuation", "12 .. !"),
            ("en", None, None), ("zz", "x", "rare words here"), ("zz", "y", None),
            *[("én", "É", "Straße STRASSE straße 日本 Ünï"), ("én", "e", "straße Straße ünï Ünï 日本")] * 3]


@pytest.fixture(scope="module")
def docs(spark, rows):
    schema = "lang string, source string, text string, term string, shard string, n string, part string, rank string"
    return spark.createDataFrame([(*r, "t", "s", "n", "p", "r") for r in rows], schema).repartition(4)


def result(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("terms, cells", [(1_000_000, 1 << 17), (0, 1 << 17), (60, 50)])
def test_equals_brute_force(docs, rows, monkeypatch, terms, cells):
    monkeypatch.setattr(divergence, "BROADCAST_TERMS", terms)  # all, none and some terms by broadcast hashes
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    monkeypatch.setattr(divergence, "SHARD_TERMS", 64)
    assert result(divergence.audit(docs, top=20)) == brute(rows, top=20)


def test_limits(docs, rows):
    assert result(divergence.audit(docs, least=1, top=5)) == brute(rows, 1, 5)
    assert divergence.audit(docs.limit(0)).count() == 0
    assert result(divergence.audit(docs.where("lang = 'zz'"))) == [
        ("zz", "x", "pair", "y", 0, 1), ("zz", "y", "pair", "x", 0, 1)]


def table_of(terms, shards):
    shard = divergence.shard_of(divergence.hashes(terms)[0], shards)
    return divergence.PerfectHash([divergence.built(terms[shard == i]) for i in range(shards)])


@pytest.mark.parametrize("shards", [1, 7, 3000])
def test_perfect_hash(shards):
    terms = np.array([f"w{i}" for i in range(5000)] + ["é", "日本"], dtype=object)
    table = table_of(terms, shards)
    numbers = table.numbers(terms)
    assert sorted(numbers) == list(range(len(terms))) and table.terms.take(numbers).to_pylist() == terms.tolist()
    others = np.array([f"x{i}" for i in range(5000)], dtype=object)
    assert (table.numbers(others) == -1).all() and (table_of(terms[:0], shards).numbers(others) == -1).all()


def test_terms_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(divergence, "hashes", lambda t: (np.zeros(len(t), np.uint64), np.ones(len(t), np.uint64)))
    same = table_of(np.array(["a", "b", "c"], dtype=object), 2)
    assert sorted(same.numbers(np.array(["c", "q", "a", "b"], dtype=object))) == [-1, 0, 1, 2]


def test_shares_are_exact():
    counts = np.array([0, 1, 7, 10**14, 3 * 10**14], dtype=np.int64)
    whole = int(counts.sum()) + 5
    assert divergence.shares(counts, whole).tolist() == [1 + 10**9 * (int(c) + 1) // whole for c in counts]


def test_slots_go_by_one_number_without_names():
    table = table_of(np.array(["a", "b", "é"], dtype=object), 1)
    task = divergence.Recount({"en": table}, set(), [("en", ""), ("en", "s")])
    task.add("en", "s", divergence.terms_of("A b2É\x00b'zz[Zz"))
    slots, others = [b.to_pylist() for b in task.out()]
    number = dict(zip(table.terms.to_pylist(), range(3)))
    assert {r["slot"]: r["n"] for r in slots} == {(1 << 32) + number["a"]: 1, (1 << 32) + number["b"]: 2}
    assert all(r["lang"] is r["source"] is r["term"] is None for r in slots)
    assert [(r["slot"], r["lang"], r["source"], r["n"]) for r in others] == [(None, "en", "s", 1), (None, "en", "s", 2)]


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x250))) + "aBc dEF\u2028日本 \x1cx\x85y \U0001f600z K"
    assert divergence.terms_of(text) == re.findall(rb"[A-Za-z\x80-\xff]+", text.encode().lower())
