from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from noticehouse.llm import packing
from noticehouse.llm.common import tokenizer_file

LIBRARY = Tokenizer.from_file(tokenizer_file())


def check(lengths, window):
    """Every id in one piece, pieces gapless, sequences full or a power of two."""
    covered = defaultdict(list)
    sequences = list(packing.pack_lengths(lengths, window))
    for made in sequences:
        size = sum(p[2] for p in made)
        assert size == window or size & (size - 1) == 0
        for doc, start, length in made:
            assert length > 0
            covered[doc].append((start, length))
    for doc, length in enumerate(lengths):
        at = 0
        for start, size in sorted(covered[doc]):
            assert start == at
            at += size
        assert at == length
    return sequences


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=60), st.sampled_from([1, 16, 64]))
def test_all_ids_are_packed_without_padding(lengths, window):
    check(lengths, window)


def test_no_more_sequences_than_needed():
    random = np.random.default_rng(1)
    lengths = random.integers(1, 3000, 4000).tolist()
    sequences = check(lengths, 4096)
    partial = sum(sum(p[2] for p in made) < 4096 for made in sequences)
    assert partial <= 12
    assert len(sequences) - partial == sum(lengths) // 4096


def test_combinations_spare_cuts():
    """Where lengths fit each other, the solved counts leave next to nothing to cut."""
    lengths = [100] * 500 + [156] * 500 + [64] * 300 + [128] * 150
    sequences = check(lengths, 256)
    assert sum(map(len, sequences)) <= len(lengths) * 1.02


def test_solved_counts_match_a_solvable_histogram():
    counts = np.zeros(257, np.int64)
    counts[[100, 156, 64, 128]] = 50, 50, 40, 20
    combos = packing.combinations(counts, 256)
    assert (combos.sum(axis=1) == 256).all()
    made = np.zeros(257)
    for combo, times in zip(combos, packing.solve_counts(combos, counts, 500)):
        assert times >= 0
        for v in combo:
            made[v] += times
    assert np.abs(made[1:] - counts[1:]).max() < 1
    used = defaultdict(int)
    for combo, times in packing.exact_windows(counts, 256):
        for v in combo:
            used[v] += times
    assert all(used[v] <= counts[v] for v in used)


def test_documents_are_packed_whole(documents, clashing):
    texts = ["", None, "one two three", "word " * 900, "word " * 900, "x y " * 5000]
    docs = documents(*texts, **clashing).repartition(2)
    pieces = packing.pack_documents(docs, tokenizer_file(), window=512, block_tokens=2000).collect()
    for doc_id, text in enumerate(texts):
        expected = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted((p for p in pieces if p["doc_id"] == doc_id), key=lambda p: p["start"])
        got = [i for p in own for i in np.frombuffer(p["ids"], "<u4").tolist()]
        assert got == expected
        assert {p["doc_tokens"] for p in own} == {len(expected)}
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 512 or at & (at - 1) == 0


def test_empty_table_and_bad_window(documents):
    assert packing.pack_documents(documents(), tokenizer_file()).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(documents("a"), tokenizer_file(), window=100)
