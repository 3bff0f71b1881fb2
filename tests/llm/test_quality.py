import random

import numpy as np
import pytest

from noticehouse.llm import quality
from noticehouse.llm.quality import STATISTICS, fit_rules, holds, lasso_logistic, statistics

WORDS = "the river runs past old houses and small gardens where people walk in summer evenings".split()


def good(chance):
    return ". ".join(" ".join(chance.choices(WORDS, k=9)).capitalize() for _ in range(6)) + "."


def junk(chance):
    word = chance.choice(WORDS)
    return chance.choice([f"{word} " * 60, " | ".join(WORDS) * 3, good(chance).upper().replace(" ", "!! ")])


def corpus(spark, documents, n=240, **columns):
    chance = random.Random(4)
    kinds = [chance.random() < 0.7 for _ in range(n)]
    docs = documents(*(good(chance) if k else junk(chance) for k in kinds), **columns)
    labels = spark.createDataFrame([(i, int(k)) for i, k in enumerate(kinds)], "doc_id bigint, quality int")
    return docs, labels, kinds


def test_statistics():
    found = dict(zip(STATISTICS, statistics(b"AB ab ab\nAB ab #")))
    assert found["upper"] == 0.4 and found["marks"] == 1 / 16 and found["newlines"] == 1 / 16
    assert found["distinct_words"] == 0.5 and found["repeated_next"] == 1 / 6
    assert found["distinct_lines"] == 1 and found["words_to_marks"] == 1 / 6
    assert statistics(b"") == (0.0,) * len(STATISTICS)
    assert all(np.isfinite(statistics(t)).all() for t in (b" ", b"\n\n", "é".encode(), b"x" * 10**6))


def test_lasso_is_a_minimum():
    random_ = np.random.default_rng(0)
    r = (random_.random((300, 8)) < 0.4).astype(float)
    y = (random_.random(300) < 1 / (1 + np.exp(1 - 3 * r[:, 0] + 2 * r[:, 1]))).astype(float)
    penalty = 0.02
    b, w = lasso_logistic(r, y, penalty, 3000)

    def loss(b, w):
        m = b + r @ w
        return np.mean(np.logaddexp(0, m) - y * m) + penalty * np.abs(w).sum()

    assert (w == 0).sum() >= 3 and w[0] > 0 > w[1]
    for k in range(8):
        for step in (-0.01, 0.01):
            other = w.copy()
            other[k] += step
            assert loss(b, other) >= loss(b, w) - 1e-9


def test_compiled_rules_equal_plain_ones(spark, documents):
    docs, labels, _ = corpus(spark, documents)
    model = quality.fit_quality(docs, labels)
    assert 0 < len(model.rules) < 200 and list(model.describe())
    rows = {r["doc_id"]: r for r in quality.with_quality(docs, model).collect()}
    for r in rows.values():
        x = np.array([statistics(r["text"].encode())])
        margin = model.intercept + sum(w for rule, w in model.rules if holds(rule, x)[0])
        assert r["quality_score"] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-12)


def test_held_out_accuracy(spark, documents, clashing):
    docs, labels, kinds = corpus(spark, documents, **clashing)
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == len(kinds)
    held = [r for r in rows if r["held_out"]]
    assert 40 < len(held) < 120
    assert sum(r["predicted"] == kinds[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_held_out_labels_are_not_used(spark, documents):
    docs, labels, _ = corpus(spark, documents)
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) as quality"
    )
    assert quality.fit_quality(docs, labels) == quality.fit_quality(docs, turned)


def test_odd_rows_and_labels(spark, documents):
    docs = documents("a good text", None, "", (None, "no id"), (0, "a good text"))
    labels = spark.createDataFrame(
        [(0, 1), (0, 1), (0, 0), (None, 1), (77, 0), (1, None)], "doc_id bigint, quality int"
    )
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.score_quality(documents(), labels).collect() == []


def test_one_label_only():
    model = fit_rules(np.ones((8, len(STATISTICS))), np.ones(8))
    assert model.rules == () and model.intercept == pytest.approx(np.log(9))


def test_a_very_long_text_and_repeated_rows(spark, documents):
    docs, labels, _ = corpus(spark, documents, 60)
    long = documents((900, "many plain words in a row. " * 80_000), (901, None), (902, ""), (901, None))
    found = quality.score_quality(docs.unionByName(long), labels).where("doc_id >= 900").collect()
    scores = {(r.doc_id, r.score) for r in found}
    assert len(found) == 4 and len(scores) == 3 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id > 900}) == 1
