import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbcast.llm.pieces import PieceModel, encoded

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL, LIBRARY = PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=800, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=" \n▁abetinoshr.é日😀!=", max_size=60),
                 st.text(alphabet="abcdefilmnorstu ", max_size=60)))
def test_equals_the_library(text):
    ids = LIBRARY.encode(text)
    assert MODEL.encode(text) == ids
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["", " ", "  ", "\n", " a  b ", "▁▁ a", " " * 50 + "z", "aaaaaaaaaaaa", "=" * 40, "the " * 2000])
def test_special_texts(text):
    assert MODEL.encode(text) == LIBRARY.encode(text) and MODEL.decode(MODEL.encode(text)) == LIBRARY.decode(LIBRARY.encode(text))


def test_tables(documents, odd):
    got = encoded(documents(odd), PATH).collect()
    assert len(got) == len(odd)
    plain = [(t or "").replace("▁", " ") for _, t in odd]  # a space mark in a text decodes to a space
    texts = {hashlib.sha256(t.encode()).hexdigest(): t for t in plain}
    for r in got:
        ids = LIBRARY.encode(r.decoded)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 in texts and r.decoded == texts[r.decoded_sha256]
    short = encoded(documents(odd), PATH, with_ids=False)
    assert short.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert encoded(documents(odd).limit(0), PATH).count() == 0
