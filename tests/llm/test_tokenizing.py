"""Ids of chunks against the tokenizer's ids of whole texts."""

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from placeweave.llm import tokenizing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ENCODER = tokenizing.ChunkEncoder()


def ids(text, encoder=ENCODER):
    return encoder.encode(pa.array([text], pa.string()))[0].tolist()


@settings(max_examples=600, deadline=None)
@given(
    st.text(
        alphabet=st.one_of(
            st.sampled_from("abzABZ éÉßÿÀªº²¼µ.,;!?'’-_0123 \n\t ́Kİǅ漢😀ſ<|>"),
            st.characters(exclude_categories=["Cs"]),
        ),
        max_size=40,
    )
)
def test_any_text(text):
    assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("first", range(0, 0x250, 16))
def test_letters_one_by_one(first):
    for code in range(first, first + 16):
        for text in (chr(code), f"x{chr(code)}", f"{chr(code)}A.", f"É{chr(code)}é,"):
            assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids, hex(code)


def test_small_generations_give_the_same(monkeypatch):
    monkeypatch.setattr(tokenizing, "PARTS_KEPT", 5)
    encoder = tokenizing.ChunkEncoder(id_type="<u4")
    texts = ["One two, three. Four five; six!", "two Three four-five élan", "", "one " * 9 + "x" * 200]
    for _ in range(3):
        found, at = encoder.encode(pa.array(texts))
        for text, low, high in zip(texts, at[:-1], at[1:]):
            assert found[low:high].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_every_letter_before_every_mark():
    letters = [c for c in map(chr, range(0x11_0000)) if c.isalpha() and len(c.lower()) > 1 or "\xaa" <= c < "\u0600" and c.isalpha()]
    for mark in tokenizing.MARKS:
        for text in [f"DAK{c}{mark}" for c in letters] + [f"GAZETESİ{mark}{mark}", f"İ{mark}"]:
            assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids, ascii(text)
