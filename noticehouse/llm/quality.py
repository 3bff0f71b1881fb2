"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees are grown on statistics of labelled texts. Every path from
a root is a conjunctive rule. A logistic model with an L1 penalty weighs the
rules, most of them to zero, and what is left is compiled into one Spark column
expression over the statistics.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticehouse.llm.common import kept, split_of, text_bytes
from noticehouse.llm.labels import SAMPLE_ROWS, labelled_texts

STATISTICS = (
    "log_bytes", "upper", "digits", "punctuation", "marks", "space", "newlines", "beyond_ascii",
    "word_bytes", "longest_word", "distinct_words", "repeated_next", "words_to_marks",
    "distinct_lines", "line_bytes", "byte_entropy",
)
SCHEMA = T.StructType([T.StructField(name, T.DoubleType()) for name in STATISTICS])

TREES, DEPTH, LEAF_ROWS, BINS, STEP = 30, 3, 10, 24, 0.4
PENALTY, ROUNDS = 1e-3, 400

#: Statistic, true for "above" or false for "up to", threshold.
Condition = tuple[int, bool, float]
Rule = tuple[Condition, ...]

_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGITS = np.arange(48, 58)
_SENTENCE = np.frombuffer(b".,;:!?'\"()-", np.uint8)
_MARKS = np.array([b for b in range(33, 127) if not chr(b).isalnum() and b not in _SENTENCE])
_MARK_BYTES = bytes(_MARKS.astype(np.uint8))


def statistics(text: bytes) -> tuple[float, ...]:
    """The statistics of a UTF-8 text, in the order of STATISTICS; all are 0 for an
    empty one."""
    if not text:
        return (0.0,) * len(STATISTICS)
    size = len(text)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), text.split(b"\n")
    upper, lower = seen[_UPPER].sum(), seen[_LOWER].sum()
    beyond = seen[128:].sum()
    spaces = seen[9:14].sum() + seen[32]
    share = seen[seen > 0] / size
    n = max(len(words), 1)
    return (
        float(np.log1p(size)),
        upper / max(upper + lower, 1),
        seen[_DIGITS].sum() / size,
        seen[_SENTENCE].sum() / size,
        seen[_MARKS].sum() / size,
        spaces / size,
        seen[10] / size,
        beyond / size,
        (size - spaces) / n,
        float(max(map(len, words), default=0)),
        len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(w[-1] in _MARK_BYTES for w in words) / n,
        len(set(lines)) / len(lines),
        size / len(lines),
        float(-(share * np.log2(share)).sum()),
    )


def _statistics_of(bodies: pd.Series) -> pd.DataFrame:
    kept("statistics", dict)  # no model of another stage is needed
    return pd.DataFrame([statistics(b) for b in bodies], columns=list(STATISTICS))


statistics_udf = F.pandas_udf(_statistics_of, SCHEMA)


def boosted_paths(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list[Rule]:
    """Paths of trees, each fitted to what the ones before it leave."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    base = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    margin, rules = np.full(len(y), base), {}

    def grow(rows: np.ndarray, path: Rule, depth: int) -> None:
        if path:
            rules.setdefault(_merged(path))
        p = 1 / (1 + np.exp(-margin[rows]))
        grad, hess = y[rows] - p, p * (1 - p) + 1e-6
        if depth < DEPTH and len(rows) >= 2 * LEAF_ROWS:
            best = (1e-6, -1, 0.0)
            whole = grad.sum() ** 2 / (hess.sum() + 1)
            for k in random.permutation(x.shape[1])[: 2 + x.shape[1] // 2]:
                if not len(cuts[k]):
                    continue
                place = np.searchsorted(cuts[k], x[rows, k], "left")
                size = len(cuts[k]) + 1
                g = np.cumsum(np.bincount(place, grad, size))[:-1]
                h = np.cumsum(np.bincount(place, hess, size))[:-1]
                n = np.cumsum(np.bincount(place, minlength=size))[:-1]
                gain = g**2 / (h + 1) + (grad.sum() - g) ** 2 / (hess.sum() - h + 1) - whole
                gain[(n < LEAF_ROWS) | (len(rows) - n < LEAF_ROWS)] = -1
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (float(gain[at]), int(k), float(cuts[k][at]))
            if best[1] >= 0:
                _, k, cut = best
                above = x[rows, k] > cut
                grow(rows[~above], (*path, (k, False, cut)), depth + 1)
                grow(rows[above], (*path, (k, True, cut)), depth + 1)
                return
        margin[rows] += STEP * grad.sum() / (hess.sum() + 1)

    for _ in range(TREES):
        grow(np.arange(len(y)), (), 0)
    return list(rules)


def _merged(path: Rule) -> Rule:
    """The tightest condition per statistic and side."""
    tight: dict[tuple[int, bool], float] = {}
    for k, above, cut in path:
        old = tight.get((k, above), cut)
        tight[k, above] = max(old, cut) if above else min(old, cut)
    return tuple(sorted((k, above, cut) for (k, above), cut in tight.items()))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    kept = np.ones(len(x), bool)
    for k, above, cut in rule:
        kept &= (x[:, k] > cut) if above else (x[:, k] <= cut)
    return kept


def lasso_logistic(
    r: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS
) -> tuple[float, np.ndarray]:
    """Intercept and weights minimising the mean log loss plus an L1 penalty, by
    accelerated proximal gradient steps."""
    rows = np.hstack([np.ones((len(r), 1)), r])
    v = np.ones(rows.shape[1])
    for _ in range(20):
        v = rows.T @ (rows @ v)
        v /= np.linalg.norm(v)
    rate = 4 * len(rows) / np.linalg.norm(rows @ v) ** 2
    w = ahead = np.zeros(rows.shape[1])
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ ahead, -30, 30)))
        new = ahead - rate * (rows.T @ (p - y)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self, statistic) -> Column:
        """The score as a column; ``statistic`` gives the column of a name."""
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            met = F.lit(True)
            for k, above, cut in rule:
                value = statistic(STATISTICS[k])
                met = met & ((value > cut) if above else (value <= cut))
            margin = margin + F.when(met, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-margin))

    def describe(self) -> Iterator[str]:
        for rule, weight in sorted(self.rules, key=lambda r: -abs(r[1])):
            said = (f"{STATISTICS[k]} {'>' if above else '<='} {cut:.4g}" for k, above, cut in rule)
            yield f"{weight:+.3f} if {' and '.join(said)}"


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Without both labels the score is the labels' smoothed mean."""
    if len(y) == 0 or y.min() == y.max():
        return RuleModel(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), ())
    rules = boosted_paths(x, y)
    met = np.stack([holds(rule, x) for rule in rules], axis=1).astype(float)
    intercept, weights = lasso_logistic(met, y)
    kept = [(rule, float(w)) for rule, w in zip(rules, weights) if abs(w) > 1e-4]
    return RuleModel(intercept, tuple(kept))


def fit_quality(
    docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1, most: int = SAMPLE_ROWS
) -> RuleModel:
    """Fit on at most ``most`` labelled documents that are not held out; a few
    numbers of each reach the driver."""
    known = labelled_texts(docs, labels, "quality", parts, held_out, most)
    rows = known.select("label", statistics_udf("body").alias("s")).select("label", "s.*")
    found = rows.toPandas()
    x = found[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS))
    order = np.lexsort(np.column_stack([found["label"], x]).T)
    return fit_rules(x[order], found["label"].to_numpy(float)[order])


def with_quality(docs: DataFrame, model: RuleModel, name: str = "quality_score") -> DataFrame:
    """Whole texts scored from 0 to 1; null text is empty. A column of that name is
    replaced; an empty table stays empty."""
    held = "__statistics"
    scored = docs.withColumn(held, statistics_udf(text_bytes()))
    return scored.withColumn(name, model.column(lambda s: F.col(f"{held}.{s}"))).drop(held)


def score_quality(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted``, a row per row of ``docs``.

    A null text is scored as an empty one, and both like any other; equal texts score
    alike. A null id is in part 0 and has no label. Labels are learnt from documents
    that are not held out; null labels, and labels of no document, teach nothing. An
    empty table gives no row. Of ``docs`` other columns are not read.
    """
    model = fit_quality(docs, labels, parts, held_out)
    scored = with_quality(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        (split_of("doc_id", parts) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
