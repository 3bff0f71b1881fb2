import duckdb
import numpy as np
import pytest
from hypothesis import given, strategies as st

from noticehouse.llm import lm_score
from noticehouse.llm.oracles import ORACLES

TEXTS = [
    (1, "the cat sat on the mat"), (2, "The cat sat\ton the  mat."), (3, None), (4, ""), (5, "word"),
    (6, "the cat " * 300), (1, "the cat sat on the mat"), (None, "mat the on"), (7, " \n "), (8, "é É the CAT"),
]


def expected(rows):
    db = duckdb.connect()
    db.execute("create table documents (doc_id bigint, text varchar)")
    if rows:
        db.executemany("insert into documents values (?, ?)", rows)
    return sorted(db.execute(ORACLES["op3_stupid_backoff"]).fetchall(), key=str)


def scored(docs):
    return sorted((tuple(r) for r in lm_score.score_documents(docs).collect()), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_sql(documents, clashing, monkeypatch, small):
    if small:
        monkeypatch.setattr(lm_score, "RANGE_WORDS", 50)
        monkeypatch.setattr(lm_score, "CHUNK_BYTES", 40)
    assert scored(documents(*TEXTS, **clashing).repartition(3)) == expected(TEXTS)


def test_no_documents(documents):
    assert scored(documents()) == []


def test_nothing_but_empty_texts(documents):
    assert scored(documents("", None)) == expected([(0, ""), (1, None)])


@given(st.lists(st.integers(0, 2**64 - 1), max_size=40))
def test_packed_numbers(values):
    data = np.array(values, np.uint64)
    assert lm_score.unpack(lm_score.pack(data), "<u8").tolist() == values
    small = (data % (1 << 32)).astype("<u4")
    assert lm_score.unpack(lm_score.pack(small), "<u4").tolist() == small.tolist()


def test_a_frequent_pair_is_one_entry_per_chunk(spark, documents):
    """Rows of a pair that every document holds do not grow with the documents."""
    chunk = lm_score.Chunk
    docs = documents(*["of the"] * 500).coalesce(1)
    coded = docs.selectExpr("doc_id", "cast(text as binary) as body")
    rows = coded.mapInPandas(lm_score._encode, lm_score.CHUNKS).collect()
    assert len(rows) == 1
    grams = chunk(rows[0]["sizes"], rows[0]["words"], rows[0]["codes"]).grams
    assert [len(g[0]) for g in grams] == [2, 1] and grams[1][2].tolist() == [500]


def test_a_very_long_text(documents):
    rows = [(1, "one two three " * 60_000), (2, "two three"), (3, "z" * 1_000_000)]
    assert scored(documents(*rows)) == expected(rows)
