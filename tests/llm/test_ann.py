import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from noticehouse.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, wanted, count):
    found = {}
    for q, x in rows:
        if wanted(q):
            scored = [(-float(np.float64(x) @ np.float64(y)), v) for v, y in rows if v != q]
            found[q] = [v for _, v in sorted(scored)][:count]
    return found


def searched(spark, rows, wanted, count=20, **options):
    df = spark.createDataFrame([(i, None if x is None else [float(v) for v in x], 0) for i, x in rows], SCHEMA)
    found = {}
    for r in ann.nearest(df, wanted, count, **options).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return found


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(3)
    x = random.standard_normal((3000, 32)) * random.uniform(0.5, 2, (3000, 1))
    return [(k, v.astype(np.float32)) for k, v in enumerate(x)]


def test_recall(spark, vectors, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 700)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 60)
    found = searched(spark, vectors, F.col("vec_id") % 20 == 0)
    truth = brute(vectors, lambda q: q % 20 == 0, 20)
    assert found.keys() == truth.keys()
    hits = sum(len({v for _, v, _ in found[q]} & set(truth[q])) for q in truth)
    assert hits / sum(map(len, truth.values())) >= 0.9
    by_id = dict(vectors)
    for q, rows in found.items():
        assert [k for k, _, _ in rows] == list(range(1, 21))
        assert [s for _, _, s in rows] == sorted((s for _, _, s in rows), reverse=True)
        for _, v, s in rows:
            assert v != q and math.isclose(s, np.float64(by_id[q]) @ np.float64(by_id[v]), rel_tol=1e-12)


def test_full_ascent_is_exact(spark, vectors):
    some = vectors[:300]
    found = searched(spark, some, F.col("vec_id") % 20 == 0, ascent=100.0)
    truth = brute(some, lambda q: q % 20 == 0, 20)
    assert {q: [v for _, v, _ in rows] for q, rows in found.items()} == truth


def test_a_hot_group_of_copies(spark):
    """A third of all rows are one vector; its queries list its smallest ids."""
    random = np.random.default_rng(5)
    hot = np.ones(8, np.float32)
    rows = [(k, hot if k % 3 == 0 else random.standard_normal(8).astype(np.float32)) for k in range(900)]
    found = searched(spark, rows, F.col("vec_id") % 20 == 0, ascent=100.0)
    truth = brute(rows, lambda q: q % 20 == 0, 20)
    for q, expected in truth.items():
        got = found[q]
        scores = {v: np.float64(dict(rows)[q]) @ np.float64(dict(rows)[v]) for _, v, _ in got}
        assert [round(scores[v], 9) for _, v, _ in got] == [
            round(float(np.float64(dict(rows)[q]) @ np.float64(dict(rows)[v])), 9) for v in expected
        ]
        if q % 3 == 0 and len(got) == 20 and all(v % 3 == 0 for v in expected):
            assert [v for _, v, _ in got] == expected


def test_odd_rows(spark):
    rows = [
        (0, [1, 0]), (1, [0, 1]), (2, [1, 1]), (2, [1, 1]), (3, None), (4, [0, 0]), (5, [math.nan, 1]),
        (6, [math.inf, 1]), (7, [1]), (8, []), (None, [1, 1]), (20, [-1, -1]), (40, [0, 0]),
    ]
    df = spark.createDataFrame(
        [(i, x and [float(v) for v in x], 0) for i, x in rows] + [(9, [None, 1.0], 0)], SCHEMA
    ).selectExpr("*", "1 as k1", "2 as rank", "3 as class_id", "4 as v", "5 as score", "6 as shard")
    found = ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [
        (0, 1, 2, 1.0), (0, 2, 1, 0.0), (0, 3, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0), (20, 3, 2, -2.0),
    ]


def test_empty_and_single(spark):
    assert searched(spark, [], F.col("vec_id") % 20 == 0) == {}
    assert searched(spark, [(0, [1.0, 2.0])], F.col("vec_id") % 20 == 0) == {}
    assert searched(spark, [(1, [1.0, 2.0]), (2, [1.0, 0.0])], F.col("vec_id") % 20 == 0) == {}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32 - 1), st.floats(0.1, 3))
def test_ascent_meets_the_longest_prefixes(seed, ascent):
    """What a shard's search scores are the rows of the deepest level that is enough."""
    random = np.random.default_rng(seed)
    rows, queries = random.standard_normal((60, 5)), random.standard_normal((3, 5))
    forest = ann.fit_forest(rows, float((rows * rows).sum(axis=1).max()), 4, 6)
    keys, wanted = forest.keys(rows), forest.keys(queries, queries=True)
    for k, found, scores in ann.search_shard(forest, rows, queries, ascent, 5):
        for dropped in range(7):
            same = keys >> dropped == wanted[k] >> dropped
            if same.sum() >= min(max(ascent * 60, 4 * 5), 4 * 60):
                break
        reached = np.flatnonzero(same.any(axis=1))
        best = reached[np.argsort(-(rows[reached] @ queries[k]))[:5]]
        assert sorted(found.tolist()) == sorted(best.tolist())
        assert np.allclose(scores, rows[found] @ queries[k])
