import numpy as np
import pytest
import xxhash
from hypothesis import given, strategies as st
from tokenizers import Tokenizer

from noticehouse.llm import bitplanes
from noticehouse.llm.common import tokenizer_file
from noticehouse.session import scratch_path

LIBRARY = Tokenizer.from_file(tokenizer_file())
IDS = st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50)


@given(IDS, st.sampled_from([1, 8]))
def test_planes_round_trip(values, bits):
    ids = np.array(values, np.uint32)
    planes = bitplanes.to_planes(ids, bits)
    assert bitplanes.from_planes(planes, len(ids), bits).tolist() == values
    assert len(planes) <= 32 // bits


@given(st.lists(IDS, max_size=6), st.sampled_from([1, 8]), st.integers(1, 20))
def test_a_file_round_trips_over_block_borders(docs, bits, block):
    writer = bitplanes.FileWriter(bits, block)
    for k, values in enumerate(docs):
        writer.add(None if k == 2 else k - 1, np.array(values, "<u4").tobytes())
    found = list(bitplanes.FileReader(writer.finish()).documents())
    start = 0
    for k, (values, (doc_id, at, data)) in enumerate(zip(docs, found, strict=True)):
        assert (doc_id, at) == (None if k == 2 else k - 1, start)
        assert np.frombuffer(data, "<u4").tolist() == values
        start += len(values)


def test_a_cut_file_is_refused():
    writer = bitplanes.FileWriter(8, 4)
    writer.add(1, b"\1\0\0\0")
    with pytest.raises(ValueError):
        bitplanes.FileReader(writer.finish()[:-1])


@pytest.mark.parametrize("bits", [1, 8])
def test_documents_come_back_in_order(documents, clashing, bits):
    texts = [(5, "the cat"), (1, None), (9, ""), (3, "word " * 400), (None, "no id"), (5, "a"), (7, "x")]
    docs = documents(*texts, **clashing).repartition(3)
    read = bitplanes.token_files(docs, tokenizer_file(), bits=bits, block_ids=64, file_ids=100)
    rows = sorted(read.collect(), key=lambda r: r["start"])
    expected, start = [], 0
    def order(row):
        tie = np.uint64(xxhash.xxh64_intdigest((row[1] or "").encode(), 42)).astype(np.int64)
        return row[0] is not None, row[0] or 0, tie

    for doc_id, text in sorted(texts, key=order):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), ids))
        start += len(ids)
    found = [
        (r["doc_id"], r["start"], r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows
    ]
    assert found == expected


def test_files_of_a_failed_attempt_are_not_read(spark, documents):
    folder = scratch_path(spark, "files")
    manifest = bitplanes.write_token_files(documents("a b", "c"), folder, tokenizer_file(), 2)
    stray = bitplanes.FileWriter(8, 64)
    stray.add(99, b"\1\0\0\0")
    bitplanes.write_file(folder, "stray.bplane", stray.finish())
    found = bitplanes.read_token_files(spark, folder, manifest)
    assert sorted(r["doc_id"] for r in found.collect()) == [0, 1]


def test_rows_without_an_id_are_spread(spark, documents):
    docs = documents(*((None, f"text {k}") for k in range(4000)), *((7, f"other {k}") for k in range(2000)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = bitplanes.write_token_files(docs, scratch_path(spark, "files"), tokenizer_file(), 2)
        parts = {r["part"]: r["n_docs"] for r in manifest.collect()}
        assert len(parts) == 4 and max(parts.values()) < 2500
        starts = [r["start"] for r in bitplanes.token_files(docs, tokenizer_file()).collect()]
        assert len(set(starts)) == 6000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_documents_no_files(documents):
    assert bitplanes.token_files(documents(), tokenizer_file()).collect() == []
