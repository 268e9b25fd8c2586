import itertools
import random
import struct
import time
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kerbcast.llm.packing import Bins, WordTokens, fewest_bins, improve, packed, packed_block

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_give_the_ids_of_whole_texts(tokenizer):
    words, rng = WordTokens(PATH), random.Random(1)
    letters = "abETZéÉßÿÀ×÷'s!-_`~^.{}ΣσİıK0٣µºª²½<|>endoftext \n\t\x0b\x1c\xa0́"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60))) + rng.choice(["", "<|endoftext|>", "don't we're"])
        split = text.encode().split()
        words.learn(set(split))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert b"".join(words[w] for w in split) == struct.pack(f"<{len(ids)}I", *ids)


def check_sequences(rows, capacity):
    placed = defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed)


def test_tables(documents, odd, prose, tokenizer):
    rows = [*odd, *[(100 + i, prose(i, i * 7 % 90)) for i in range(80)]]
    got = packed(documents(rows), PATH, max_tokens=64, block_pieces=40).collect()
    check_sequences(got, 64)
    want = []
    for d, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(str(d), k, at, len(ids[at:at + 64]), zlib.crc32(struct.pack(f"<{len(ids[at:at + 64])}I", *ids[at:at + 64])))
                 for k, at in enumerate(range(0, len(ids), 64))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)


def test_few_sequences():
    rng = random.Random(5)
    for top in (300, 1200, 2047):
        lengths = [rng.randrange(1, top) for _ in range(3000)]
        number, offset = packed_block(lengths, 2048)
        assert max(number) + 1 <= 1.012 * -(-sum(lengths) // 2048) or top > 1024
        ends = defaultdict(int)
        for n, o, size in zip(number, offset, lengths):
            ends[n] = max(ends[n], o + size)
        assert max(ends.values()) <= 2048 and set(number) == set(range(max(number) + 1))


def test_local_search_empties_a_bin():
    # 6+3, 5+3, 4+3 in bins of ten: only exchanging 3 for 4 and moving the rest leaves two full bins and a third.
    bins, length = Bins(10), [6, 3, 5, 3, 3]
    for items in ([0, 1], [2, 3], [4]):
        bins.items.append(list(items))
        bins.fill.append(sum(length[i] for i in items))
    bins.free = sorted((10 - f, b) for b, f in enumerate(bins.fill))
    before = sum(f * f for f in bins.fill)
    improve(bins, length)
    assert sorted(i for b in bins.items for i in b) == list(range(5))
    assert max(bins.fill) <= 10 and sum(f * f for f in bins.fill) >= before
    assert [sum(length[i] for i in b) for b in bins.items] == bins.fill


def fewest_by_trial(length, capacity):
    """The fewest bins of a few pieces: each piece in turn goes to every bin that has room."""
    best = len(length)

    def place(at, fill):
        nonlocal best
        if len(fill) >= best:
            return
        if at == len(length):
            best = len(fill)
            return
        for b in range(len(fill)):
            if fill[b] + length[at] <= capacity:
                place(at + 1, [*fill[:b], fill[b] + length[at], *fill[b + 1:]])
        place(at + 1, [*fill, length[at]])

    place(0, [])
    return best


def test_bound_of_bins():
    rng = random.Random(2)
    for _ in range(300):
        length = [rng.randrange(rng.choice([1, 6, 10]), 21) for _ in range(rng.randrange(1, 9))]
        assert fewest_bins(length, 20) <= fewest_by_trial(length, 20) <= max(packed_block(length, 20)[0]) + 1
    assert fewest_bins([], 20) == 0 and fewest_bins([11] * 5, 20) == 5 and fewest_bins([7] * 6, 20) == 3


def test_search_leaves_no_exchange():
    rng = random.Random(4)
    for _ in range(60):
        length = [rng.randrange(5, 16) for _ in range(40)]
        number, _ = packed_block(length, 40)
        bins = [[i for i, n in enumerate(number) if n == b] for b in range(max(number) + 1)]
        fill = [sum(length[i] for i in b) for b in bins]
        if len(bins) == fewest_bins(length, 40):
            continue
        for s, t in itertools.permutations(range(len(bins)), 2):
            if fill[s] > fill[t] or fill[s] == 40 or fill[t] == 40:
                continue
            given = [sum(x) for k in (1, 2) for x in itertools.combinations([length[i] for i in bins[s]], k)]
            assert not any(0 < g - length[i] <= 40 - fill[t] for g in given for i in bins[t])


def test_a_full_block_in_seconds():
    rng = random.Random(6)
    for low, high in ((700, 1100), (1, 2047), (400, 550)):
        length = [rng.randrange(low, high) for _ in range(16_384)]
        start = time.process_time()
        number, _ = packed_block(length, 2048)
        assert time.process_time() - start < 20
        assert max(number) + 1 <= 1.06 * fewest_bins(length, 2048)


def test_large_ids_beside_null_ids(documents):
    ids = [2**62 + 1, None, 2**53 + 1, -(2**62) - 1]
    got = packed(documents([(d, "some words") for d in ids]), PATH).collect()
    assert {r.doc_id for r in got} == set(ids)


def test_empty_table(documents):
    assert packed(documents([(1, "x")]).limit(0), PATH).count() == 0
