import hashlib
from collections import defaultdict

import pytest

from kerbcast.llm.exact_copies import copy_groups, without_copies


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("share", [1 / 4096, 0.05, 0.5])
def test_groups(documents, odd, share):
    rows = [*odd, *[(100 + i, ("Hot TEXT", "hot text")[i % 2]) for i in range(60)], *[(200 + i, f"É {i // 3}") for i in range(30)]]
    got = copy_groups(documents(rows), share).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for d, t in rows:
        groups[hashlib.sha256(low(t).encode()).hexdigest()].append(d)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_rows_that_stay(documents, odd):
    rows = [*odd, (50, "A b"), (51, "a B")]
    docs = documents(rows)
    out = without_copies(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in out.collect())
    assert (51, "a B") in got and (50, "A b") not in got
    assert len(got) == len({low(t) for _, t in rows}) == len({low(t) for _, t in got})


def test_repeated_rows_stay_once(documents):
    rows = [(7, "same"), (7, "SAME"), (None, "alone"), (None, "alone"), (8, "other"), (3, "same"), (9, None), (9, "")]
    for share in (1 / 4096, 0.5):
        got = [(r.doc_id, low(r.text)) for r in without_copies(documents(rows), share).collect()]
        assert sorted(got, key=str) == sorted([(7, "same"), (None, "alone"), (8, "other"), (9, "")], key=str)


def test_empty_table(documents):
    empty = documents([(1, "x")]).limit(0)
    assert copy_groups(empty).count() == 0 and without_copies(empty).count() == 0
