import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from noticehouse.llm import tokens
from noticehouse.llm.common import tokenizer_file
from noticehouse.llm.tokens import TextEncoder, slices

LIBRARY = Tokenizer.from_file(tokenizer_file())
ENCODER = TextEncoder(tokenizer_file(), 2)
PIECES = ["ab", "Don't", "'ll ", "é", "é", "İ", " ", "\n\t", "\x1c", "\xa0", ".", ",", "...", "!.",
          "9", "12.5", "<|endoftext|>", "<|ENDOFTEXT|>", "漢字", "🙂", "ﬁ", "K"]


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join) | st.text(max_size=40))
def test_ids_are_those_of_the_whole_text(text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids + [2]
    assert ids(ENCODER.encode([text.encode("utf-8", "replace")])[0]) == expected


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 4)
    small = TextEncoder(tokenizer_file())
    texts = [b"one two three. four", b"", b"four five six, seven", b"one seven"]
    for text in texts * 2:
        expected = LIBRARY.encode(text.decode(), add_special_tokens=False).ids
        assert ids(small.encode([text])[0]) == expected


def test_slices_cover_all_texts_in_order():
    texts = [b"x" * n for n in (5, 1, 0, 9, 30, 2, 2)]
    parts = list(slices(texts, 10))
    assert [t for a, b in parts for t in texts[a:b]] == texts
    assert all(sum(map(len, texts[a:b])) <= 10 or b - a == 1 for a, b in parts)
    assert list(slices([], 10)) == []
