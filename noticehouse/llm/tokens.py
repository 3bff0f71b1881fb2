"""Token ids of whole texts by the tokenizers library.

The vocabulary's pre-tokenizer never joins characters across white space, so a
text's ids are the ids of its words (ASCII white space between) in a row. Each
distinct word is encoded by the library once and kept while the cache has room.
The vocabulary's normalizer lower-cases, so ASCII letters are lower-cased first;
only a text that may hold a special token's string is left as it is.
"""

from __future__ import annotations

import os
import sys
from array import array
from itertools import islice

from noticehouse.llm.common import kept

CACHED_WORDS = 700_000
WORDS_AT_ONCE = 20_000
_MARKS = (b".", b",")


class TextEncoder:
    """Ids as bytes: little-endian unsigned 32-bit.

    For vocabularies that lower-case and drop white space, whose special tokens
    are written ``<|...|>``.
    """

    def __init__(self, path: str, end_id: int | None = None):
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise NotImplementedError("ids are kept as the machine's 32-bit words")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._end = b"" if end_id is None else end_id.to_bytes(4, "little")
        self._words: dict[bytes, bytes] = {}

    def _learn(self, words: set[bytes]) -> None:
        """Words after whose last letter a full stop or comma stands share the ids of
        the word without it: letters and marks are never joined."""
        marked = [w for w in words if w[-1:] in _MARKS and w[-2:-1].isalpha()]
        bare = {w[:-1] for w in marked}
        bare.update(words.difference(marked), (w[-1:] for w in marked))
        new = [w for w in bare if w not in self._words]
        for at in range(0, len(new), WORDS_AT_ONCE):
            part = new[at : at + WORDS_AT_ONCE]
            texts = [w.decode("utf-8", "replace") for w in part]
            encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for word, e in zip(part, encoded):
                self._words[word] = array("I", e.ids).tobytes()
        for word in marked:
            self._words[word] = self._words[word[:-1]] + self._words[word[-1:]]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text, with the end id if one is set."""
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        wanted = set().union(*split) if split else set()
        if len(self._words) > CACHED_WORDS:
            # Frequent words are met early, so the first ones learnt stay.
            self._words = dict(islice(self._words.items(), CACHED_WORDS // 2))
        self._learn(wanted.difference(self._words))
        of = self._words.__getitem__
        return [b"".join(map(of, words)) + self._end for words in split]


def encoder(path: str, end_id: int | None = None) -> TextEncoder:
    return kept((path, end_id), lambda: TextEncoder(path, end_id))


def slices(texts, most: int = 4 << 20):
    """Positions of consecutive texts with at most ``most`` bytes together (one
    text at least), so that a batch of long texts is not expanded at once."""
    start = size = 0
    for at, text in enumerate(texts):
        if at > start and size + len(text) > most:
            yield start, at
            start, size = at, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
