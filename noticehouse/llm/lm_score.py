"""Language-model scores by stupid backoff over counts of the whole corpus.

Texts become chunks of word numbers with the hashes of their words. Each chunk
counts its own n-grams once, so a frequent n-gram is one entry per chunk, and
sends them to the hash range they lie in. There the entries of all chunks are
summed, and every chunk gets back the totals of the n-grams it has, in order. A
chunk then looks up each position's n-gram and sums the log scores by document.

The score of a word after another is the pair's count over the first one's if
the pair is in the table, which keeps pairs seen ``least`` times or more, and
otherwise a discounted unigram share. A document's first word has its share.
Log scores are rounded to millionths, so sums do not depend on their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.llm.common import stage, text_bytes
from noticehouse.llm.tokens import slices

BACKOFF, LEAST = 0.4, 2
CHUNK_BYTES = 8 << 20
#: Words of the corpus per hash range.
RANGE_WORDS = 1 << 20
CACHED_WORDS = 500_000

CHUNKS = "chunk bigint, doc_ids array<bigint>, sizes array<int>, words binary, codes binary"
ENTRIES = "part bigint, order int, chunk bigint, hashes binary, counts binary"
TOTALS = "chunk bigint, order int, part bigint, totals binary"
SCORES = "doc_id bigint, n_words bigint, micro bigint"


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    octets = values.view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.compress(octets.T.tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    octets = raw.reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(octets.T).reshape(-1).view(kind)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two hashes, evenly spread over 64 bits."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words, each computed once while there is room."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents to chunks: word numbers by falling frequency, and their hashes."""
    number = TaskContext.get().partitionId() << 33
    known = WordHashes()
    for batch in batches:
        ids, texts = batch["doc_id"].astype("Int64").tolist(), batch["body"].tolist()
        for a, b in slices(texts, CHUNK_BYTES):
            if len(known) > CACHED_WORDS:
                known.clear()
            words = [text.lower().split() for text in texts[a:b]]
            sizes = [len(w) for w in words]
            hashes = np.fromiter(
                (known[w] for own in words for w in own), np.uint64, sum(sizes)
            )
            distinct, codes, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            row = (
                number,
                [None if i is pd.NA else i for i in ids[a:b]],
                sizes,
                pack(distinct[order]),
                pack(rank[codes]),
            )
            yield pd.DataFrame([row], columns=["chunk", "doc_ids", "sizes", "words", "codes"])
            number += 1


class Chunk:
    """A chunk's words and its n-grams: sorted hashes, counts, and each position's
    place among them."""

    def __init__(self, sizes: list[int], words: bytes, codes: bytes):
        self.sizes = np.asarray(sizes, np.int64)
        hashes = unpack(words, "<u8")[unpack(codes, "<u4")]
        self.first = np.zeros(len(hashes), bool)
        starts = np.cumsum(self.sizes) - self.sizes
        self.first[starts[self.sizes > 0]] = True
        #: Positions that follow another word of their document.
        self.later = np.flatnonzero(~self.first)
        pairs = pair_hashes(hashes[self.later - 1], hashes[self.later])
        self.grams = [
            np.unique(h, return_inverse=True, return_counts=True) for h in (hashes, pairs)
        ]

    def scores(self, totals: list[np.ndarray], words: int, backoff: float, least: int) -> np.ndarray:
        """The log score of each document, in millionths."""
        own = totals[0][self.grams[0][1]].astype(float)
        value = np.log(own / words)
        if len(self.later):
            pair = totals[1][self.grams[1][1]].astype(float)
            known = np.log(pair / own[self.later - 1])
            value[self.later] = np.where(
                pair >= least, known, np.log(backoff * own[self.later] / words)
            )
        micro = np.round(value * 1e6).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(micro)])
        stops = np.cumsum(self.sizes)
        return ends[stops] - ends[stops - self.sizes]


def _sum(entries: pd.DataFrame) -> pd.DataFrame:
    """The totals of one hash range, for each chunk's own n-grams."""
    entries = entries.sort_values("chunk")
    hashes = [np.cumsum(unpack(h, "<u8")) for h in entries["hashes"]]
    counts = np.concatenate([unpack(c, "<u4") for c in entries["counts"]])
    _, place = np.unique(np.concatenate(hashes), return_inverse=True)
    sums = np.bincount(place, counts).astype("<u8")[place]
    cuts = np.cumsum([len(h) for h in hashes])[:-1]
    return pd.DataFrame(
        {
            "chunk": entries["chunk"],
            "order": entries["order"],
            "part": entries["part"],
            "totals": [pack(t) for t in np.split(sums, cuts)],
        }
    )


def score_documents(docs: DataFrame, backoff: float = BACKOFF, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``n_words``, ``log_score`` (natural logarithm) and ``per_word``.

    Words end at ASCII white space; ASCII letters are lower-cased. Null and empty
    texts have no words, score 0 and a null share per word. Repeated rows count
    and are scored like any other; an empty table gives no row.
    """
    bodies = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("body")
    )
    chunks = stage(bodies.mapInPandas(_encode, CHUNKS), "lm-chunks")
    words = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda s, n: s + n))).head()[0] or 0
    parts = 1 + words // RANGE_WORDS
    begins = np.array([k * (1 << 64) // parts for k in range(parts)], np.uint64)

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, _, sizes, words_, codes in batch.itertuples(index=False):
                rows = []
                for order, (hashes, _, counts) in enumerate(Chunk(sizes, words_, codes).grams):
                    at = np.append(np.searchsorted(hashes, begins), len(hashes))
                    for part in np.flatnonzero(at[1:] > at[:-1]).tolist():
                        own = hashes[at[part] : at[part + 1]]
                        steps = np.diff(own, prepend=np.uint64(0))
                        some = counts[at[part] : at[part + 1]].astype("<u4")
                        rows.append((part, order, number, pack(steps), pack(some)))
                names = ["part", "order", "chunk", "hashes", "counts"]
                yield pd.DataFrame(rows, columns=names)

    def score(own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        _, doc_ids, sizes, words_, codes = own.iloc[0]
        found = found.sort_values(["order", "part"])
        totals = []
        for order in (0, 1):
            some = [unpack(t, "<u8") for t in found.loc[found["order"] == order, "totals"]]
            totals.append(np.concatenate(some) if some else np.zeros(0, np.uint64))
        micro = Chunk(sizes, words_, codes).scores(totals, words, backoff, least)
        made = pd.DataFrame({"doc_id": pd.array(list(doc_ids), "Int64"), "n_words": sizes})
        return made.assign(micro=micro)

    sums = (
        chunks.select("chunk", "doc_ids", "sizes", "words", "codes")
        .mapInPandas(entries, ENTRIES)
        .groupBy("part", "order")
        .applyInPandas(_sum, TOTALS)
    )
    scored = (
        chunks.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInPandas(score, SCORES)
    )
    return scored.select(
        "doc_id",
        "n_words",
        (F.col("micro") / F.lit(1e6)).alias("log_score"),
        F.when(F.col("n_words") > 0, F.col("micro") / F.lit(1e6) / F.col("n_words")).alias("per_word"),
    )
