"""Toxicity: Levenshtein automata over a lexicon trie, and context windows.

A lexicon of words and word beginnings is learnt from labelled texts. Its trie
is intersected with Levenshtein automata: a state is the set of trie nodes
reachable within the allowed edits, built as words need it, so a word is looked
up in one walk and most words end it after a few letters. The words around a hit
tell a quotation from abuse. A document's score comes from its worst hit.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticehouse.llm.common import kept, split_of, stage
from noticehouse.llm.labels import SAMPLE_ROWS, labelled_texts
from noticehouse.llm.tokens import slices

#: Lengths of the word beginnings that may become terms; terms of a lexicon at most.
STEMS = (4, 5, 6)
MOST_TERMS = 4000
LEAST_PRECISION = 0.7
WINDOW = 5
#: Words remembered per worker with what they match.
CACHED_WORDS = 400_000

EDGES = ".,;:!?\"'()[]{}<>|*&%$#«»“”„‚‘’…-–—_/\\~^`+="
OPENING, CLOSING = "\"“„«‚‘", "\"”“»’‘"
#: Words that report speech, in a few languages.
REPORTING = frozenset(
    "said says wrote writes quoted quote called calls word words term phrase slur insult"
    " sagte schrieb nannte zitat wort begriff dit écrit appelé mot terme citation"
    " dijo escribió llamó palabra término cita".split()
)
RESULT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("hits", T.IntegerType()),
        T.StructField("worst", T.StringType()),
    ]
)

#: A term (a trailing * marks a beginning) and the edits to it.
Match = tuple[str, int]


def edits_allowed(term: str) -> int:
    """Beginnings and short words must match as they are."""
    if term.endswith("*") or len(term) < 4:
        return 0
    return 2 if len(term) >= 10 else 1


class Lexicon:
    """Words to their nearest term, by a lazily built deterministic automaton."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.words: list[str | None] = [None]
        self.stems: list[str | None] = [None]
        #: Edits allowed to some term below a node.
        self.reach = [0]
        for term in sorted(terms):
            node, most = 0, edits_allowed(term)
            self.reach[0] = max(self.reach[0], most)
            for letter in term.removesuffix("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.words.append(None)
                    self.stems.append(None)
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], most)
            (self.stems if term.endswith("*") else self.words)[node] = term
        self._states: list[dict[int, int]] = []
        self._numbers: dict[tuple, int] = {}
        self._steps: list[dict[str, int]] = []
        self._start = self._state({0: 0}) if terms else -1
        self._cache: dict[str, Match | None] = {}

    def _state(self, reached: dict[int, int]) -> int:
        """The number of a set of nodes with their edits, closed under letters
        missing from the word; -1 for the empty set."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                edits = reached[node] + 1
                if edits <= self.reach[child] and edits < reached.get(child, 99):
                    reached[child] = edits
                    todo.append(child)
        if not reached:
            return -1
        key = tuple(sorted(reached.items()))
        if key not in self._numbers:
            self._numbers[key] = len(self._states)
            self._states.append(reached)
            self._steps.append({})
        return self._numbers[key]

    def _step(self, state: int, letter: str) -> int:
        after: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.reach[node] and edits < after.get(node, 99):
                after[node] = edits

        for node, edits in self._states[state].items():
            reach(node, edits + 1)
            for mark, child in self.children[node].items():
                reach(child, edits + (mark != letter))
            if letter in self.children[node]:
                child = self.children[node][letter]
                after[child] = min(edits, after.get(child, 99))
        self._steps[state][letter] = found = self._state(after)
        return found

    def _stem(self, word: str) -> str | None:
        """The longest beginning of the word that is a term."""
        node, found = 0, None
        for letter in word:
            node = self.children[node].get(letter)
            if node is None:
                break
            found = self.stems[node] or found
        return found if found and len(word) >= len(found) else None

    def match(self, word: str) -> Match | None:
        """The nearest term; a beginning before a word with edits, ties by name."""
        state = self._start
        for letter in word:
            if state < 0:
                break
            step = self._steps[state].get(letter)
            state = self._step(state, letter) if step is None else step
        best = None
        if state >= 0:
            for node, edits in self._states[state].items():
                term = self.words[node]
                if term and edits <= edits_allowed(term):
                    best = min(best or (edits, term), (edits, term))
        if best is None or best[0]:
            stem = self._stem(word)
            if stem:
                return stem, 0
        return best and (best[1], best[0])

    def matches(self, words: set[str]) -> dict[str, Match]:
        """Those of a batch's words that match, with the edges stripped."""
        if self._start < 0:
            return {}
        if len(self._cache) > CACHED_WORDS:
            self._cache = {}
        found, cache = {}, self._cache
        for word in words:
            if word in cache:
                hit = cache[word]
            else:
                hit = cache[word] = self.match(word.strip(EDGES))
            if hit:
                found[word] = hit
        return found


@dataclass(frozen=True)
class Hit:
    term: str
    edits: int
    quoted: bool
    around: tuple[str, ...]


def hits_in(words: list[str], matched: dict[str, Match]) -> list[Hit]:
    """Hits of a lower-cased, split text with the words around them."""
    found = []
    for at, word in enumerate(words):
        hit = matched.get(word)
        if hit:
            low = max(0, at - WINDOW)
            before, after = words[low:at], words[at + 1 : at + 1 + WINDOW]
            opens = word[0] in OPENING or any(w[0] in OPENING for w in before)
            closes = word.rstrip(".,;:!?")[-1:] in CLOSING or any(
                w.rstrip(".,;:!?")[-1:] in CLOSING for w in after
            )
            around = tuple(w.strip(EDGES) for w in (*before, *after))
            found.append(Hit(*hit, opens and closes, around))
    return found


@dataclass(frozen=True)
class ToxicModel:
    #: Log odds of a text with no hit, and of the hits by term and edits.
    base: float
    terms: tuple[tuple[str, int, float], ...]
    #: What a word near a hit adds to its log odds.
    cues: tuple[tuple[str, float], ...]
    #: Intercept and weights of a text's evidence; see :func:`evidence`.
    weights: tuple[float, ...] = (0.0, 1.0, 0.25, 0.0, 0.0)


def evidence(odds: list[float], terms: int, words: int) -> tuple[float, ...]:
    """1, the worst hit's log odds, and the logarithms of the hits, of the different
    terms, and of the hits in a hundred words."""
    hits = len(odds)
    return 1.0, max(odds), math.log(hits), math.log(terms), math.log(100 * hits / words)


class Scorer:
    def __init__(self, model: ToxicModel):
        self.base, self.final = model.base, model.weights
        self.weights = {(t, d): w for t, d, w in model.terms}
        self.cues = dict(model.cues)
        self.lexicon = Lexicon(sorted({t for t, _, _ in model.terms}))

    def odds(self, hit: Hit) -> float:
        """A hit's log odds: a quotation that is reported counts against abuse."""
        own = self.weights.get((hit.term, hit.edits), self.base)
        reported = any(w in REPORTING for w in hit.around)
        quotation = 1 / (1 + math.exp(-(4.0 * hit.quoted + 3.0 * reported - 5.0)))
        learnt = max((self.cues.get(w, 0.0) for w in hit.around), key=abs, default=0.0)
        return own * (1 - quotation) + self.base * quotation + learnt

    def found(
        self, texts: list[str | None]
    ) -> Iterator[tuple[tuple[float, ...], list[Hit], list[float]] | None]:
        """The evidence of each text, its hits and their log odds; None without a hit."""
        split = [(t or "").lower().split() for t in texts]
        distinct = [set(words) for words in split]
        matched = self.lexicon.matches(set().union(*distinct)) if distinct else {}
        for words, own in zip(split, distinct):
            if own.isdisjoint(matched):
                yield None
                continue
            hits = hits_in(words, matched)
            odds = [self.odds(h) for h in hits]
            yield evidence(odds, len({h.term for h in hits}), len(words)), hits, odds

    def score(self, texts: list[str | None]) -> list[tuple[float, int, str | None]]:
        scored = []
        for found in self.found(texts):
            if not found:
                scored.append((_sigmoid(self.base), 0, None))
                continue
            row, hits, odds = found
            total = sum(w * x for w, x in zip(self.final, row))
            worst = hits[max(range(len(hits)), key=odds.__getitem__)]
            scored.append((_sigmoid(total), len(hits), worst.term))
        return scored


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def scorer(model: ToxicModel) -> Scorer:
    return kept(model, lambda: Scorer(model))


def _family(words: list[str]) -> int:
    """The same for copies, and mostly for texts that differ in few words: the least
    hash of two words in a row."""
    pairs = {" ".join(p) for p in zip(words, words[1:])} or {" ".join(words)}
    return int.from_bytes(min(map(xxhash.xxh64_digest, pairs))) >> 1


def _terms_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Label, family and terms of each text."""
    for batch in batches:
        rows = []
        for label, body in zip(batch["label"], batch["body"]):
            words = body.decode("utf-8", "replace").lower().split()
            clean = {w.strip(EDGES) for w in words}
            terms = {w for w in clean if len(w) > 2}
            terms |= {w[:n] + "*" for w in clean for n in STEMS if len(w) > n}
            rows.append((label, _family(words), sorted(terms)))
        yield pd.DataFrame(rows, columns=["label", "family", "terms"])


def learn_lexicon(texts: DataFrame) -> dict[str, tuple[int, int]]:
    """Terms that mark toxic texts, with their toxic and clean families.

    Copies of a text are one family. A term counts if its toxic share is beyond
    chance even among as many terms as there are (a log likelihood ratio), and
    high in itself. A beginning that stands for one word is that word.
    """
    found = stage(texts.mapInPandas(_terms_of, "label int, family bigint, terms array<string>"), "terms")
    sides = found.agg(
        F.count_distinct(F.when(F.col("label") == 1, F.col("family"))).alias("pos"),
        F.count_distinct(F.when(F.col("label") == 0, F.col("family"))).alias("neg"),
    ).head()
    if not sides["pos"] or not sides["neg"]:
        return {}
    share = sides["pos"] / (sides["pos"] + sides["neg"])
    counted = stage(
        found.select("label", "family", F.explode("terms").alias("term"))
        .distinct()
        .groupBy("term")
        .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
        .where("pos > 1"),
        "term-counts",
    )
    tested = max(counted.count(), 1)
    both = F.col("pos") + F.col("neg")
    ratio = F.col("pos") * F.log(F.col("pos") / both / share) + F.when(
        F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / both / (1 - share))
    ).otherwise(0.0)
    marked = (
        counted.where((ratio >= math.log(tested) + 2) & (F.col("pos") >= LEAST_PRECISION * both))
        .orderBy(F.desc(ratio), "term")
        .limit(MOST_TERMS)
        .collect()
    )
    terms = {r["term"]: (r["pos"], r["neg"]) for r in marked}
    return {t: n for t, n in terms.items() if not _stands_for_less(t, terms)}


def _stands_for_less(term: str, terms: dict[str, tuple[int, int]]) -> bool:
    """Whether a longer term explains nearly all toxic texts of a beginning."""
    if not term.endswith("*"):
        return False
    begin, pos = term[:-1], terms[term][0]
    return any(
        other != term and other.startswith(begin) and n[0] >= 0.95 * pos
        for other, n in terms.items()
    )


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0, most: int = SAMPLE_ROWS
) -> ToxicModel:
    """Fit on at most ``most`` labelled documents that are not held out. Without
    both labels the model knows the labels' mean only."""
    texts = stage(labelled_texts(docs, labels, "toxic", parts, held_out, most), "toxic-sample", 64 * most)
    counts = texts.agg(F.count("*").alias("n"), F.sum("label").alias("pos")).head()
    terms = learn_lexicon(texts)
    draft = ToxicModel(0.0, tuple((t, 0, 0.0) for t in sorted(terms)), ())

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = scorer(draft).lexicon
        seen: Counter[tuple[str, str, int, int]] = Counter()
        for batch in batches:
            for label, body in zip(batch["label"], batch["body"]):
                words = body.decode("utf-8", "replace").lower().split()
                hits = hits_in(words, lexicon.matches(set(words)))
                exact = {(h.term, 0) for h in hits if not h.edits}
                near = {(h.term, h.edits) for h in hits} if not exact else set()
                seen.update(("term", t, d, label) for t, d in exact | near)
                seen["hit" if hits else "none", "", 0, label] += 1
                cues = {w for h in hits for w in h.around if not h.edits}
                seen.update(("cue", w, 0, label) for w in cues)
        rows = [(*key, n) for key, n in seen.items()]
        yield pd.DataFrame(rows, columns=["kind", "name", "edits", "label", "n"])

    made = texts.mapInPandas(features, "kind string, name string, edits int, label int, n bigint")
    sums = made.groupBy("kind", "name", "edits").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("neg"),
    )
    # Cues are learnt from hits in clean texts; most words never stand near one.
    useful = sums.where("kind <> 'cue' or neg >= 10").orderBy("kind", F.desc("neg"), "name", "edits")
    rows = useful.limit(4 * MOST_TERMS).collect()
    by = {(r["kind"], r["name"], r["edits"]): (r["pos"], r["neg"]) for r in rows}
    pos, neg = by.get(("none", "", 0), (counts["pos"] or 0, counts["n"] - (counts["pos"] or 0)))
    base = math.log((pos + 0.5) / (neg + 0.5)) if terms else math.log((pos + 1) / (neg + 1))
    weights = []
    for edits in (0, 1, 2):
        own = [by.get(("term", t, edits), (0, 0)) for t in terms]
        total = (sum(n[0] for n in own) + 2, sum(n[1] for n in own) + 1)
        rate = total[0] / sum(total)
        for term, (p, n) in zip(terms, own):
            if edits <= edits_allowed(term):
                odds = math.log((p + 2 * rate) / (n + 2 * (1 - rate)))
                weights.append((term, edits, odds))
    all_pos, all_neg = by.get(("hit", "", 0), (0, 0))
    cues = tuple(
        (name, math.log((p + 1) / (all_pos + 2)) - math.log((n + 1) / (all_neg + 2)))
        for (kind, name, _), (p, n) in sorted(by.items())
        if kind == "cue" and name
    )
    draft = ToxicModel(base, tuple(weights), cues)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = scorer(draft).found([b.decode("utf-8", "replace") for b in batch["body"]])
            rows = [(label, *f[0][1:]) for label, f in zip(batch["label"], found) if f]
            yield pd.DataFrame(rows, columns=["label", "worst", "hits", "terms", "density"])

    columns = "label int, worst double, hits double, terms double, density double"
    rows = texts.mapInPandas(weigh, columns).toPandas().sort_values(
        ["label", "worst", "hits", "terms", "density"]
    )
    if rows["label"].nunique() < 2:
        return draft
    x = np.column_stack([np.ones(len(rows)), rows.drop(columns="label").to_numpy(float)])
    return replace(draft, weights=_logistic(x, rows["label"].to_numpy(float)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> tuple[float, ...]:
    """Newton steps; the ridge pulls towards the draft's weights."""
    prior = np.array(ToxicModel.weights)

    def loss(w: np.ndarray) -> float:
        margin = x @ w
        fit = np.logaddexp(0, margin) - y * margin
        return float(fit.sum() + ridge / 2 * ((w - prior) ** 2).sum())

    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step, length = np.linalg.solve(hess, grad), 1.0
        while length > 1e-4 and loss(w - length * step) > loss(w):
            length /= 2
        w = w - length * step
    return tuple(map(float, w))


def with_toxicity(docs: DataFrame, model: ToxicModel, name: str = "toxicity") -> DataFrame:
    """Documents with a column (replaced if there is one) of ``score``, number of ``hits``, and the
    ``worst`` hit's term. A null text is empty and has no hit."""

    def score(texts: pd.Series) -> pd.DataFrame:
        judge, rows, all_texts = scorer(model), [], [t or "" for t in texts]
        for a, b in slices(all_texts):
            rows += judge.score(all_texts[a:b])
        return pd.DataFrame(rows, columns=RESULT.names)

    return docs.withColumn(name, F.pandas_udf(score, RESULT)(F.col("text")))


def score_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and the ``hits`` of the lexicon, a
    row per row of ``docs``.

    A null or empty text has no hits and the score of a text without any; equal texts
    score alike. A null id is in part 0 and has no label. Labels are learnt from
    documents that are not held out; null labels, and labels of no document, teach
    nothing. An empty table gives no row. Of ``docs`` other columns are not read.
    """
    model = fit_toxicity(docs, labels, parts, held_out)
    found = with_toxicity(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        (split_of("doc_id", parts) == held_out).alias("held_out"),
        "toxicity.score",
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        "toxicity.hits",
        "toxicity.worst",
    )
