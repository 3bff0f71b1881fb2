"""Benchmark decontamination by greedy string tiling.

A document and a test item that share a seed (five words in a row) are tiled:
the longest run of words common to both and not yet marked is marked in both,
again and again, down to the length of a seed. The share of the item's words
under tiles is its coverage, whatever order the passages come in.

Seeds are found by a running Karp-Rabin hash over the words of the benchmark
and compared word by word. The benchmark is held by every task, so it is taken
in blocks of bounded size; documents pass once per block and are not shuffled.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.llm.common import stage

SEED_WORDS = 5
COVERAGE = 0.5
BLOCK_CHARS = 8 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
WORDS = re.compile(r"\w+")
FOUND = (
    "doc_id bigint, item_id bigint, coverage double, item_words int, tiled_words int,"
    " tiles array<struct<doc_word: int, item_word: int, words: int>>"
)

#: Document position, item position, number of words.
Tile = tuple[int, int, int]


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """The running hash of every window of a sequence of word numbers."""
    count = len(ids) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    value = np.zeros(count, np.uint64)
    for k in range(width):
        value = value * BASE + ids[k : k + count]
    return value


def tile(runs: list[Tile], least: int, item_size: int | None = None) -> list[Tile]:
    """Greedy tiles from the maximal runs common to two sequences.

    Longest first; ties by position in the document, then in the item. A run that
    meets marked words is cut into its unmarked parts and tried again. Where fewer
    words of the item are left than a tile needs, there are no more.
    """
    heap = [(-n, d, t) for d, t, n in runs]
    heapq.heapify(heap)
    doc_marks, item_marks, tiles = set(), set(), []
    while heap:
        if item_size is not None and item_size - len(item_marks) < least:
            break
        n, d, t = heapq.heappop(heap)
        n = -n
        free = [d + k not in doc_marks and t + k not in item_marks for k in range(n)]
        if all(free):
            doc_marks.update(range(d, d + n))
            item_marks.update(range(t, t + n))
            tiles.append((d, t, n))
            continue
        at = 0
        while at < n:
            end = at
            while end < n and free[end]:
                end += 1
            if end - at >= least:
                heapq.heappush(heap, (at - end, d + at, t + at))
            at = end + 1
    return tiles


def spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of many ranges in a row, and the range of each."""
    sizes = np.maximum(ends - starts, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - first[owner] + starts[owner], owner


def prefix_sums(ids: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Karp-Rabin sums of all beginnings of a sequence, modulo 2^64."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * powers[: len(ids)], dtype=np.uint64)])


def powers_of(base: np.uint64, count: int) -> np.ndarray:
    steps = np.full(count + 1, base)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Benchmark:
    """Test items of one block, indexed by their seeds."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int = SEED_WORDS):
        self.width, self.keys, self.items = width, [], []
        self.numbers: dict[str, int] = {}
        hashes, owners, places = [], [], []
        for key, text in items:
            words = words_of(text)
            if len(words) < width:
                continue
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            ids = np.array(ids, np.uint64)
            found = window_hashes(ids, width)
            hashes.append(found)
            owners.append(np.full(len(found), len(self.items)))
            places.append(np.arange(len(found)))
            self.keys.append(key)
            self.items.append(ids)
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.seeds = joined[order]
        self.owners = np.concatenate(owners)[order] if owners else order
        self.places = np.concatenate(places)[order] if places else order
        self.sizes = np.array([len(i) for i in self.items], np.int64)
        # All items in a row, for comparing stretches of any of them at once.
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(self.items) if self.items else np.zeros(0, np.uint64)
        self.powers = powers_of(BASE, len(self.words))
        self.sums = prefix_sums(self.words, self.powers)

    def candidates(self, hashes: np.ndarray, coverage: float) -> tuple[np.ndarray, ...]:
        """Item, place and seed number of the seeds that a text shares with those items
        which its seeds could cover far enough, whatever their order.

        A seed of very many items costs its entries once per text, however often the
        text has it.
        """
        seeds = np.unique(hashes)
        low = np.searchsorted(self.seeds, seeds, "left")
        entry, seed = spread(low, np.searchsorted(self.seeds, seeds, "right"))
        item, place = self.owners[entry], self.places[entry]
        order = np.lexsort((place, item))
        item, place, seed = item[order], place[order], seed[order]
        new = np.diff(item, prepend=-1) != 0
        fresh = np.where(new, self.width, np.minimum(np.diff(place, prepend=0), self.width))
        covered = np.bincount(item, fresh, minlength=len(self.items))
        likely = (covered >= coverage * self.sizes)[item]
        return item[likely], place[likely], seeds[seed[likely]]

    def runs(self, text: str | None, coverage: float = 0.0) -> dict[int, list[Tile]]:
        """By item: the maximal runs of words it has in common with a text.

        A run begins at a shared seed before which the words differ, so that only runs
        are listed and not the pairs of places inside them; its length is found by
        halving, with Karp-Rabin sums.
        """
        get, width = self.numbers.get, self.width
        ids = np.array([get(w, 0) for w in words_of(text)], np.uint64)
        hashes = window_hashes(ids, width)
        if not len(hashes) or not len(self.seeds):
            return {}
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        at = np.flatnonzero(known[width:] - known[:-width] == width)
        near = np.minimum(np.searchsorted(self.seeds, hashes[at]), len(self.seeds) - 1)
        at = at[self.seeds[near] == hashes[at]]
        if not len(at):
            return {}
        item, place, seed = self.candidates(hashes[at], coverage)
        if not len(item):
            return {}
        # The text's places by seed and by the word before.
        before = np.where(at > 0, ids[at - 1].astype(np.int64), -1)
        order = np.lexsort((before, hashes[at]))
        at, before, by_seed = at[order], before[order], hashes[at][order]
        whole = self.starts[item] + place
        prior = np.where(place > 0, self.words[whole - 1].astype(np.int64), -2)
        low, high = np.searchsorted(by_seed, seed, "left"), np.searchsorted(by_seed, seed, "right")
        words = np.unique(before)
        ranks, wanted = np.searchsorted(words, before), np.searchsorted(words, prior)
        found = np.append(words, -3)[wanted] == prior
        group = np.cumsum(np.diff(by_seed, prepend=~by_seed[:1]) != 0)
        keys, step = group * (len(before) + 1) + ranks, len(before) + 1
        own = np.where(low < len(at), group[np.minimum(low, len(at) - 1)], 0) * step + wanted
        same_low = np.where(found, np.searchsorted(keys, own, "left"), high)
        same_high = np.where(found, np.searchsorted(keys, own, "right"), high)
        first, owner_a = spread(low, np.minimum(same_low, high))
        second, owner_b = spread(np.maximum(same_high, low), high)
        doc = at[np.concatenate([first, second])]
        owner = np.concatenate([owner_a, owner_b])
        lengths = self._lengths(ids, doc, whole[owner], self.sizes[item[owner]] - place[owner])
        good = lengths >= width
        runs: dict[int, list[Tile]] = {}
        rows = zip(item[owner][good].tolist(), doc[good].tolist(), place[owner][good].tolist(), lengths[good].tolist())
        for number, d, t, n in rows:
            runs.setdefault(number, []).append((d, t, n))
        return runs

    def _lengths(self, ids: np.ndarray, doc: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """How many words go on alike from places of the text and of the items."""
        powers = self.powers if len(ids) < len(self.powers) else powers_of(BASE, len(ids))
        sums = prefix_sums(ids, powers)
        low, high = np.zeros(len(doc), np.int64), np.minimum(len(ids) - doc, rest)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            mine = (sums[doc + middle] - sums[doc]) * powers[whole]
            theirs = (self.sums[whole + middle] - self.sums[whole]) * powers[doc]
            alike = mine == theirs
            low, high = np.where(alike, middle, low), np.where(alike, high, middle - 1)
        # Seeds are compared word by word.
        for k in range(self.width):
            in_both = low > k
            wrong = in_both.copy()
            wrong[in_both] = ids[doc[in_both] + k] != self.words[whole[in_both] + k]
            low[wrong] = k
        return low

    def matches(self, text: str | None, coverage: float) -> Iterator[tuple]:
        for item, runs in self.runs(text, coverage).items():
            size = len(self.items[item])
            tiles = tile(runs, self.width, size)
            tiled = sum(n for _, _, n in tiles)
            if tiled >= coverage * size:
                yield self.keys[item], tiled / size, size, tiled, sorted(tiles)


def blocks_of(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The test items in blocks of about ``block_chars`` characters; at least one."""
    items = stage(
        benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text"), "benchmark"
    )
    chars = items.agg(F.sum(F.length("text"))).head()[0] or 0
    blocks = 1 + chars // block_chars
    for number in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        yield [tuple(row) for row in part.collect()]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    width: int = SEED_WORDS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item covered to at least ``coverage``.

    Words are runs of letters, digits and underscores, in lower case. Items of
    fewer words than a seed, null and empty texts match nothing. Repeated rows of
    either side give a row each; an empty table on either side gives none.
    """
    bodies = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def search(block: list[tuple]) -> DataFrame:
        index = Benchmark(block, width)

        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                    for item_id, share, size, tiled, tiles in index.matches(text, coverage):
                        spans = [dict(doc_word=d, item_word=t, words=n) for d, t, n in tiles]
                        rows.append((doc_id, item_id, share, size, tiled, spans))
                names = ["doc_id", "item_id", "coverage", "item_words", "tiled_words", "tiles"]
                made = pd.DataFrame(rows, columns=names)
                yield made.astype({"doc_id": "Int64", "item_id": "Int64"})

        return bodies.mapInPandas(find, FOUND)

    found, blocks = None, 0
    for block in blocks_of(benchmark, block_chars):
        here, blocks = search(block), blocks + 1
        if blocks == 1:
            found = here
            continue
        # Written before the next, so that one block at a time is held here.
        found = stage(found, "tiles") if blocks == 2 else found
        found = found.unionByName(stage(here, "tiles"))
    return found


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    width: int = SEED_WORDS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents that no test item is found in. Each row goes or stays by its
    own text, whatever its id: null and empty texts, and texts of fewer words than a
    seed, stay; equal rows go or stay alike. Without items, or with none long enough,
    all stay; an empty table gives no row. All columns are kept. With several blocks,
    what one leaves is written before the next, so that a task holds one block."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint")).select(docs.columns)

    def clean(docs: DataFrame, block: list[tuple]) -> DataFrame:
        index = Benchmark(block, width)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                found = (any(index.matches(t.as_py(), coverage)) for t in texts)
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))

        return docs.mapInArrow(keep, docs.schema)

    for number, block in enumerate(blocks_of(benchmark, block_chars)):
        docs = clean(stage(docs, "decontaminated") if number else docs, block)
    return docs
