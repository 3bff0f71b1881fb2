"""Packing by non-negative least squares over length combinations.

A document's ids are cut at every full window; only its rest competes for
space. The rests of a block of documents make a histogram of lengths. Shallow
combinations (two or three lengths that fill a window exactly) are enumerated,
their repeat counts solved against the histogram by non-negative least squares,
and rounded. What the rounded counts leave is packed greedily: longest first,
then the longest that fits, and a cut where none fits. The last window of a
block is cut into powers of two, which need no padding.

A block is a bounded number of tokens of one partition, so work and memory grow
with neither the table nor a hot length, nothing is shuffled, and a task that is
repeated makes the same sequences.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.llm.common import text_bytes
from noticehouse.llm.tokens import encoder, slices

WINDOW = 4096
BLOCK_TOKENS = 8 << 20
#: Third lengths tried in combinations of three: the most frequent ones.
ANCHORS = 12
ROUNDS = 60
#: Sequence numbers of one partition.
PARTITION_SEQUENCES = 1 << 33
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
    " sequence_id bigint, offset bigint"
)

#: One piece: document's position in the block, first id, number of ids.
Piece = tuple[int, int, int]


def combinations(counts: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths (the last may be 0) that fill the window, largest first."""
    present = np.flatnonzero(counts)
    pairs = present[(2 * present >= window) & (counts[np.maximum(window - present, 0)] > 0)]
    found = [np.stack([pairs, window - pairs, np.zeros_like(pairs)], axis=1)]
    anchors = present[np.argsort(-counts[present], kind="stable")][:ANCHORS]
    for third in anchors:
        rest = window - third
        first = present[(2 * present >= rest) & (present < rest)]
        first = first[counts[rest - first] > 0]
        triples = np.stack([first, rest - first, np.full_like(first, third)], axis=1)
        found.append(-np.sort(-triples, axis=1))
    return np.unique(np.concatenate(found), axis=0)


def solve_counts(combos: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 of the combinations minimising the distance of A x to counts.

    Projected gradient steps, scaled by row and column sums of A.
    """
    width = len(counts)
    used = (combos > 0).sum(axis=1)
    flat = combos.ravel()
    per_length = np.bincount(flat, minlength=width)
    scale = 1.0 / np.maximum(per_length, 1)
    scale[0] = 0.0
    target = counts.astype(float)
    target[0] = 0.0
    x = np.zeros(len(combos))
    for _ in range(rounds):
        made = np.bincount(flat, weights=np.repeat(x, 3), minlength=width)
        error = (target - made) * scale
        x = np.maximum(0.0, x + error[combos].sum(axis=1) / used)
    return x


def exact_windows(counts: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations and how often to use them, within the histogram."""
    combos = combinations(counts, window)
    if not len(combos):
        return []
    x = solve_counts(combos, counts)
    left, plan = counts.copy(), []
    for k in np.argsort(-x, kind="stable"):
        wanted = int(x[k] + 0.5)
        if not wanted:
            break
        lengths = [int(v) for v in combos[k] if v]
        times = min([wanted, *(int(left[v]) // lengths.count(v) for v in lengths)])
        if times:
            for v in lengths:
                left[v] -= times
            plan.append((tuple(lengths), times))
    return plan


def greedy_windows(rests: list[Piece], window: int) -> Iterator[list[Piece]]:
    """Longest first, then the longest that fits; a cut where nothing fits."""
    pool = sorted((length, doc, start) for doc, start, length in rests)
    while pool:
        length, doc, start = pool.pop()
        made, gap = [(doc, start, length)], window - length
        while gap and pool:
            at = bisect_right(pool, (gap, float("inf"), 0)) - 1
            length, doc, start = pool.pop(max(at, 0))
            part = min(length, gap)
            made.append((doc, start, part))
            gap -= part
            if length > part:
                insort(pool, (length - part, doc, start + part))
        yield made


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Cut a partly filled window into sequences whose lengths are powers of two."""
    todo = list(reversed(pieces))
    total = sum(p[2] for p in pieces)
    while total:
        gap, made = 1 << (total.bit_length() - 1), []
        total -= gap
        while gap:
            doc, start, length = todo.pop()
            part = min(length, gap)
            made.append((doc, start, part))
            if length > part:
                todo.append((doc, start + part, length - part))
            gap -= part
        yield made


def pack_lengths(lengths: list[int], window: int = WINDOW) -> Iterator[list[Piece]]:
    """Sequences over documents of the given lengths; each id lies in one piece."""
    rests: list[list[Piece]] = [[] for _ in range(window)]
    counts = np.zeros(window + 1, np.int64)
    for doc, length in enumerate(lengths):
        full = length - length % window
        for start in range(0, full, window):
            yield [(doc, start, window)]
        if length > full:
            rests[length - full].append((doc, full, length - full))
            counts[length - full] += 1
    for combo, times in exact_windows(counts, window):
        for _ in range(times):
            yield [rests[v].pop() for v in combo]
    for made in greedy_windows([p for bin_ in rests for p in bin_], window):
        if sum(p[2] for p in made) == window:
            yield made
        else:
            yield from powers_of_two(made)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    window: int = WINDOW,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Pack the ids of whole texts into sequences of at most ``window`` ids.

    One row per piece, with its ids (little-endian unsigned 32-bit), the sequence
    it lies in and its offset there. Sequences are full or a power of two long, so
    none is padded. A null text is empty and holds the end id alone; repeated rows
    are documents of their own; an empty table gives no piece. The window must be
    a power of two.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, end_id).encode
        sequence = TaskContext.get().partitionId() * PARTITION_SEQUENCES
        keys, ids, held = [], [], 0

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal sequence
            sizes = [len(x) // 4 for x in ids]
            rows = []
            for made in pack_lengths(sizes, window):
                offset = 0
                for doc, start, length in made:
                    body = ids[doc][4 * start : 4 * (start + length)]
                    rows.append(
                        (keys[doc], start, length, body, sizes[doc], sequence, offset)
                    )
                    offset += length
                sequence += 1
                if len(rows) >= 2000:
                    yield _pieces(rows)
                    rows = []
            if rows:
                yield _pieces(rows)

        for batch in batches:
            batch_keys, texts = batch["doc_id"].astype("Int64").tolist(), batch["body"].tolist()
            for a, b in slices(texts):
                for key, body in zip(batch_keys[a:b], encode(texts[a:b])):
                    keys.append(key)
                    ids.append(body)
                    held += len(body) // 4
                    if held >= block_tokens:
                        yield from flush()
                        keys, ids, held = [], [], 0
        if ids:
            yield from flush()

    bodies = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("body")
    )
    return bodies.mapInPandas(pack, PIECES)


def _pieces(rows: list[tuple]) -> pd.DataFrame:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
