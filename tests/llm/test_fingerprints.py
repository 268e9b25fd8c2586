import hashlib
import re
from collections import Counter

import pytest

from kerbcast.llm.fingerprints import DIGITS, SAMPLES, fingerprinted

FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def terms(text):
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    return Counter(zip(words, words[1:])) if len(words) > 1 else Counter(words)


def jaccard(a, b):
    shared = sum(min(a[k], b[k]) for k in a)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 1.0


def edits(texts):
    out = []
    for i, t in enumerate(texts):
        following, half = texts[(i + 1) % len(texts)], len(t) // 2
        out.append(t[:len(t) - half] + following[:half])
    return out


def test_edits_follow_the_order_and_likeness_is_generalised_jaccard(documents, prose):
    rows = [(3 * i - 70, prose(i % 40, 5 + 7 * (i % 23))) for i in range(120)]
    got = {r.doc_id: r for r in fingerprinted(documents(rows)).select(FIELDS).collect()}
    rows.sort(key=lambda r: -r[0])
    texts = [t for _, t in rows]
    errors = []
    for (doc_id, text), changed, following in zip(rows, edits(texts), texts[1:] + texts[:1]):
        r = got[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert len(r.fingerprint) == SAMPLES * DIGITS
        errors += [r.near_edited - jaccard(terms(text), terms(changed)), r.near_next - jaccard(terms(text), terms(following))]
    assert abs(sum(errors) / len(errors)) < 0.03
    assert sum(e * e for e in errors) / len(errors) < 0.5 / SAMPLES
    by_text = {}
    assert all(by_text.setdefault(t, got[d].fingerprint) == got[d].fingerprint for d, t in rows)


def test_weights_count(documents):
    rows = [(2, "a b " * 30), (1, "a b " * 10)]
    got = {r.doc_id: r for r in fingerprinted(documents(rows), samples=200).collect()}
    exact = jaccard(terms(rows[0][1]), terms(rows[1][1]))
    assert abs(got[2].near_next - exact) < 0.13
    assert got[2].near_next == got[1].near_next


def test_awkward_rows(documents, odd):
    got = fingerprinted(documents(odd)).select(FIELDS).collect()
    assert len(got) == len(odd)
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t in odd)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    empty = [r for r in got if r.n_chars == 0]
    assert {r.fingerprint for r in empty} == {"-" * SAMPLES * DIGITS}
    twice = [r for r in got if r.doc_id == 5]
    assert sorted(r.near_next for r in twice)[1] == 1.0


def test_single_row_is_its_own_next(documents):
    (r,) = fingerprinted(documents([(9, "one two three four")])).collect()
    assert r.near_next == 1.0
    assert r.edited_sha256 == hashlib.sha256(edits(["one two three four"])[0].encode()).hexdigest()


def test_empty_table(documents):
    assert fingerprinted(documents([(1, "x")]).limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 3, 9])
def test_buckets_meet(documents, n):
    rows = [(i * i, f"text number {i} with words") for i in range(n)]
    got = {r.doc_id: r.edited_sha256 for r in fingerprinted(documents(rows)).collect()}
    rows.sort(reverse=True)
    want = [hashlib.sha256(e.encode()).hexdigest() for e in edits([t for _, t in rows])]
    assert [got[d] for d, _ in rows] == want
