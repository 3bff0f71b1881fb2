import random

import duckdb
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from noticehouse.llm import simhash
from noticehouse.llm.components import components
from noticehouse.llm.simhash import covering_masks, fingerprint, near_duplicates


def plain_fingerprint(text, shingle=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in lowered.replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.lists(st.sampled_from(["a", "B", "ÉT", "x,", " ", "\n", "longer"]), max_size=20))
def test_fingerprint(parts):
    text = " ".join(parts)
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_spark_hashes_alike(spark):
    row = spark.sql("select xxhash64('a b c') as h").head()
    assert row["h"] == simhash.signed(xxhash.xxh64_intdigest(b"a b c", 42))


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_the_radius(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    chance = random.Random(radius)
    for _ in range(3000):
        changed = sum(1 << b for b in chance.sample(range(64), radius))
        assert any(not m & changed for m in masks)
    assert all(28 <= m.bit_count() <= 44 for m in masks)


def brute_components(values, radius):
    roots = {v: v for v in values}

    def root(v):
        while roots[v] != v:
            v = roots[v]
        return v

    for a in values:
        for b in values:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                roots[y] = x
    return {v: root(v) for v in values}


def test_links_equal_brute_force(spark):
    chance, values = random.Random(5), set()
    for _ in range(12):
        chain = chance.getrandbits(64)
        for _ in range(chance.randint(1, 8)):
            values.add(chain)
            for b in chance.sample(range(64), chance.choice((1, 2, 2, 3))):
                chain ^= 1 << b
    ball = chance.getrandbits(64)
    values |= {ball, *(ball ^ 1 << b for b in range(0, 64, 2))}
    signed = sorted(map(simhash.signed, values))
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    links = simhash.links_within_two(df)
    found = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    expected = brute_components(signed, 2)
    assert {v: found.get(v, v) for v in signed} == expected


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_of_any_graph(spark, pairs):
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    roots = {v: v for p in pairs for v in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(roots[a], roots[b])
            changed |= roots[a] != low or roots[b] != low
            roots[a] = roots[b] = low
    linked = {v for a, b in pairs if a != b for v in (a, b)}
    assert found == {v: roots[v] for v in linked}


def test_a_long_chain_is_one_component(spark):
    links = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {r["root"] for r in components(links, "a", "b").collect()} == {0}


def test_groups_of_documents(documents, clashing):
    base = " ".join(f"word{k}" for k in range(400))
    near = base + " extra"
    docs = documents(
        (4, base), (2, near), (9, base), (7, ""), (3, None), (8, "alone in the world"), (8, base),
        (None, base), (None, "nobody else says this"), **clashing,
    )
    rows = near_duplicates(docs).collect()
    assert len(rows) == 9
    found = sorted(((r["doc_id"], r["component_id"]) for r in rows), key=str)
    assert (4, 2) in found and (9, 2) in found and (2, 2) in found and (8, 2) in found
    assert (7, 3) in found and (3, 3) in found and (8, 8) in found
    assert (None, 2) in found and (None, None) in found
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 3, 8, None]


def test_distinct_texts_of_one_id_stay(documents):
    docs = documents((1, "a b c d"), (1, "a b c d"), (2, "quite another text"), (2, "and a third one"))
    maps = docs.selectExpr("*", "map('a', 1) as row_key", "map('b', doc_id) as ROW_KEY_")
    for table in (docs, maps):
        kept = simhash.drop_near_duplicates(table)
        assert kept.columns == table.columns
        found = sorted((r["doc_id"], r["text"]) for r in kept.collect())
        assert found == [(1, "a b c d"), (2, "and a third one"), (2, "quite another text")]


def test_long_texts_and_a_hot_fingerprint(documents):
    long = "some words of a text " * 100_000
    rows = [(k, long if k < 2 else "the same few words in all of these") for k in range(40)]
    assert {r["component_id"] for r in near_duplicates(documents(*rows)).collect()} == {0, 2}
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(documents(*rows)).collect()) == [0, 2]


def test_no_documents(documents):
    assert near_duplicates(documents()).collect() == []
    assert simhash.drop_near_duplicates(documents()).collect() == []


def test_query_against_duckdb(spark):
    """Exact groups of the smallest tables, by comparing all pairs in SQL."""
    from noticehouse.llm.queries import QUERIES

    rows = QUERIES["op4_simhash"](spark, "/root/testdata/sf0.001").collect()
    table = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    values = {i: plain_fingerprint(t or "") for i, t in table}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in rows} == values
    roots = brute_components(sorted(set(values.values())), 2)
    least = {}
    for i, v in sorted(values.items(), reverse=True):
        least[roots[v]] = i
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: least[roots[v]] for i, v in values.items()}
