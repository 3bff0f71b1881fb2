"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text recognises all its substrings.
A document is parsed from left to right into the longest phrases the automaton
follows; the fewer phrases, the closer the language. Phrases times the bits of a
position in the training text, per byte, estimate the cross entropy
(Ziv-Merhav), and the smallest estimate wins.

Texts are cut into segments that many automaton runs follow side by side. Every
byte of a text is parsed; a cut ends a phrase alike for all languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticehouse.llm.common import kept, split_of

UNKNOWN = "und"
#: A language is learnt from at most this many passages of so many characters.
PASSAGES, PASSAGE_CHARS = 64, 1000
#: Bytes of the tables a worker keeps; it decides speed only, never what is learnt.
TABLE_BYTES = 160 << 20
SEGMENT, SEGMENTS_AT_ONCE = 512, 1 << 14
#: A text whose ended phrases cost even the best language more bits per byte than
#: this is in none of them. A text within one phrase costs nothing.
MOST_BITS = 6.0

RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits", T.DoubleType()),
    ]
)

LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters and all bytes of longer characters stay, the rest parts words.
KEPT = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def normal(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(KEPT).split())


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions per state; state 0 is the start, and every path from it spells a
    substring of the text."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for byte in text:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and byte not in moves[p]:
            moves[p][byte] = state
            p = link[p]
        if p >= 0:
            q = moves[p][byte]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(byte) == q:
                    moves[p][byte] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return moves


class Automaton:
    """A language's suffix automaton: its transitions as arrays, and as a table over
    the bytes it knows while there is room for one.

    A table's entry is the next state's row, or, where a phrase ends, the complement
    of the row that the byte leads to from the start.
    """

    def __init__(self, text: bytes):
        moves = suffix_automaton(text)
        seen = sorted(moves[0])
        self.codes = np.full(256, len(seen), np.int32)
        self.codes[seen] = np.arange(len(seen))
        self.states, self.width = len(moves), len(seen) + 1
        self._from = np.repeat(np.arange(len(moves), dtype=np.int32), [len(m) for m in moves])
        n = len(self._from)
        self._byte = np.fromiter((b for m in moves for b in m), np.uint8, n)
        self._to = np.fromiter((s for m in moves for s in m.values()), np.int32, n)
        self.position_bits = np.log2(max(len(text), 2))

    @property
    def table_bytes(self) -> int:
        return 4 * self.states * self.width

    def table(self) -> np.ndarray:
        first = np.zeros(self.width, np.int32)
        starts = self._from == 0
        first[self.codes[self._byte[starts]]] = self._to[starts] * self.width
        table = np.empty((self.states, self.width), np.int32)
        table[:] = ~first
        table[self._from, self.codes[self._byte]] = self._to * self.width
        return table.ravel()


class Parser:
    """The automata of all languages.

    Tables are kept for the first languages, up to ``TABLE_BYTES``; those of the
    others are made anew, one at a time, for each part of the texts. So any number
    of languages keeps its whole training text.
    """

    def __init__(self, training: dict[str, bytes]):
        self.languages = sorted(training)
        self.automata = [Automaton(training[language]) for language in self.languages]
        self.position_bits = [a.position_bits for a in self.automata]
        self._tables: dict[int, np.ndarray] = {}
        room = TABLE_BYTES
        for k, automaton in enumerate(self.automata):
            if automaton.table_bytes <= room:
                room -= automaton.table_bytes
                self._tables[k] = automaton.table()

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases that end within each text, by language."""
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = np.frombuffer(b"".join([*texts, bytes(SEGMENT)]), np.uint8)
        per_text = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        starts = (np.cumsum(sizes) - sizes)[owner] + nth * SEGMENT
        lengths = np.minimum(sizes[owner] - nth * SEGMENT, SEGMENT)
        order = np.argsort(-lengths, kind="stable")
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        for k, automaton in enumerate(self.automata):
            table = self._tables.get(k)
            if table is None:
                table = automaton.table()
            codes_of = automaton.codes[flat]
            for at in range(0, len(order), SEGMENTS_AT_ONCE):
                part = order[at : at + SEGMENTS_AT_ONCE]
                longest = int(lengths[part[0]])
                codes = np.ascontiguousarray(
                    codes_of[starts[part][:, None] + np.arange(longest)].T
                )
                active = np.searchsorted(-lengths[part], -np.arange(longest), "left")
                state = np.zeros(len(part), np.int32)
                ended = np.zeros(len(part), np.int32)
                for step in range(longest):
                    n = active[step]
                    found = table[state[:n] + codes[step, :n]]
                    sign = found >> 31
                    state[:n] = found ^ sign
                    ended[:n] -= sign
                counts[:, k] += np.bincount(owner[part], ended, len(texts)).astype(np.int64)
        return counts

    def identify(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, score and bits per byte of each text."""
        bodies = [b" %b " % normal(t) if t and LETTER.search(t) else b"" for t in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0, 0.0)] * len(texts)
        sizes = np.maximum([len(b) for b in bodies], 1)
        per_phrase = np.array(self.position_bits) / sizes[:, None]
        bits = (self.phrases(bodies) + 1) * per_phrase  # the last phrase is open
        found = []
        for body, row in zip(bodies, bits):
            best = int(np.argmin(row))
            rest = np.delete(row, best)
            score = 1 - row[best] / rest.min() if len(rest) else 1.0
            whole = float(row[best] - per_phrase[len(found), best])
            found.append((self.languages[best], float(score), whole))
            if not body:
                found[-1] = (UNKNOWN, 0.0, 0.0)
        return found


def parser_of(training: tuple[tuple[str, bytes], ...]) -> Parser:
    return kept(training, lambda: Parser(dict(training)))


def learn_languages(
    docs: DataFrame, parts: int = 4, held_out: int = 2
) -> tuple[tuple[str, bytes], ...]:
    """Training text per language, from documents that are not held out.

    Passages are taken by a hash of the id and start at a place given by it, so
    the sample is bounded per language, and no language has less for there being
    many. Texts without letters, null texts and null
    languages teach nothing.
    """
    hashed = F.xxhash64("doc_id")
    room = F.greatest(F.length("text") - PASSAGE_CHARS, F.lit(0)) + 1
    passages = (
        docs.where("lang is not null and text is not null")
        .where(split_of("doc_id", parts) != held_out)
        .select(
            F.col("lang").cast("string").alias("lang"),
            hashed.alias("place"),
            F.substring("text", F.pmod(hashed, room) + 1, F.lit(PASSAGE_CHARS)).alias("passage"),
        )
        .where(F.length("passage") >= 20)
    )
    order = Window.partitionBy("lang").orderBy("place", "passage")
    chosen = passages.withColumn("n", F.row_number().over(order)).where(F.col("n") <= PASSAGES)
    texts: dict[str, list[bytes]] = {}
    for lang, _, passage, _ in sorted(tuple(r) for r in chosen.collect()):
        if LETTER.search(passage):
            texts.setdefault(lang, []).append(normal(passage))
    return tuple((lang, b" ".join(t)) for lang, t in sorted(texts.items()))


def with_language(
    docs: DataFrame, training: tuple[tuple[str, bytes], ...], name: str = "language"
) -> DataFrame:
    """Documents with a column (replaced if there is one) of ``lang_pred``, ``score`` (how much
    better than the second best, 0 to 1) and ``bits``.

    A null text or one without a letter is ``und`` with score 0, as is any text
    when nothing was learnt. Equal estimates go to the first language by name.
    """

    def identify(texts: pd.Series) -> pd.DataFrame:
        parser = parser_of(training)
        found = [x for part in _parts(texts.tolist()) for x in parser.identify(part)]
        return pd.DataFrame(found, columns=RESULT.names)

    udf = F.pandas_udf(identify, RESULT)
    return docs.withColumn(name, udf(F.col("text")))


def _parts(texts: list[str | None], chars: int = 4 << 20) -> Iterator[list[str | None]]:
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text or "")
        if held >= chars:
            yield part
            part, held = [], 0
    if part:
        yield part


def identify_languages(docs: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``, a row per row of ``docs``.

    A null or empty text, or one without a letter, is ``und`` with score 0; equal
    texts are predicted alike, ties go to the first language by name. A null id is in
    part 0. Null languages teach nothing; where nothing can be learnt every text is
    ``und``. An empty table gives no row. Other columns are not read.
    """
    training = learn_languages(docs, parts, held_out)
    found = with_language(docs.select("doc_id", "text"), training)
    return found.select(
        "doc_id",
        (split_of("doc_id", parts) == held_out).alias("held_out"),
        "language.lang_pred",
        "language.score",
    )


def keep_identified(docs: DataFrame, most_bits: float = MOST_BITS) -> DataFrame:
    """The documents in one of the languages learnt from the documents themselves.

    Null and empty texts, texts without a letter and texts over ``most_bits`` bits a
    byte in every language go; equal rows go or stay alike, whatever their id. All
    columns are kept. An empty table gives no row.
    """
    held = "__language"
    found = with_language(docs, learn_languages(docs), held)
    known = F.col(f"{held}.lang_pred") != UNKNOWN
    return found.where(known & (F.col(f"{held}.bits") <= most_bits)).drop(held)
