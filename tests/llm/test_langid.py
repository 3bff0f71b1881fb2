import random

import pytest
from hypothesis import given, settings, strategies as st

from noticehouse.llm import langid
from noticehouse.llm.langid import Parser, normal, suffix_automaton

WORDS = {
    "en": "the and of to in that was with his which for from this had are they were people time water".split(),
    "de": "der die und nicht ist mit sich auch von werden haben über schön zwischen straße menschen zeit".split(),
    "fr": "le la les des une dans pour qui que avec être était où très élève français temps eau gens".split(),
}


@given(st.text("abc", max_size=30).map(str.encode), st.text("abc", max_size=8).map(str.encode))
def test_automaton_knows_all_substrings(text, word):
    moves, state = suffix_automaton(text), 0
    for byte in word:
        state = moves[state].get(byte, -1)
        if state < 0:
            break
    assert (state >= 0) == (word in text)


def plain_phrases(text, training):
    """Phrases that end: each the longest start of the rest found in training."""
    ended = 0
    for at in range(0, len(text), langid.SEGMENT):
        part, start = text[at : at + langid.SEGMENT], 0
        for end in range(1, len(part) + 1):
            if part[start:end] not in training:
                ended += 1
                start = end - 1 if part[end - 1 : end] in training else end
    return ended


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcx ", max_size=40).map(str.encode), max_size=6), st.sampled_from([3, 7, 512]))
def test_phrases_equal_the_definition(texts, segment):
    old, langid.SEGMENT = langid.SEGMENT, segment
    try:
        training = {"p": b"abcab bca", "q": b"ccc ab", "r": b""}
        parser = Parser(training)
        expected = [[plain_phrases(t, training[k]) for k in "pqr"] for t in texts]
        assert parser.phrases(texts).tolist() == expected
        parser._tables.clear()  # as where there is no room to keep any
        assert parser.phrases(texts).tolist() == expected
    finally:
        langid.SEGMENT = old


def corpus(documents, n=120, **columns):
    chance, rows = random.Random(3), []
    for k in range(n):
        lang = chance.choice(sorted(WORDS))
        rows.append((k, " ".join(chance.choices(WORDS[lang], k=chance.randint(8, 60))), lang))
    docs = None
    for lang in WORDS:
        part = documents(*((k, t) for k, t, x in rows if x == lang), lang=lang, **columns)
        docs = part if docs is None else docs.unionByName(part)
    return docs, {k: lang for k, _, lang in rows}


def test_held_out_accuracy(documents, clashing):
    docs, truth = corpus(documents, **clashing)
    rows = langid.identify_languages(docs).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and len(held) > 15
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(truth)


def test_texts_without_letters(documents):
    docs, _ = corpus(documents)
    odd = documents((900, None), (901, ""), (902, "123 !!\n"), (903, "漢字かな"), (None, "der die und nicht"))
    rows = langid.identify_languages(docs.unionByName(odd)).collect()
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert found[900] == found[901] == found[902] == ("und", 0.0)
    assert found[903][0] in WORDS and found[None][0] == "de"
    kept = langid.keep_identified(docs.unionByName(odd))
    assert {900, 901, 902}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_a_long_text_counts_whole(documents):
    """Its beginning is in one language, most of it in another."""
    docs, _ = corpus(documents)
    chance = random.Random(9)
    text = " ".join(chance.choices(WORDS["en"], k=2000) + chance.choices(WORDS["de"], k=60_000))
    training = langid.learn_languages(docs)
    found = langid.with_language(documents((1, text)), training).head()["language"]
    assert found["lang_pred"] == "de"


def test_nothing_learnt(documents):
    docs = documents("some text", None, lang=None)
    assert {r["lang_pred"] for r in langid.identify_languages(docs).collect()} == {"und"}
    assert langid.keep_identified(docs).collect() == []
    assert langid.identify_languages(documents()).collect() == []


SCRIPTS = ["abcdefghijklmnop", "абвгдежзийклмнопрст", "αβγδεζηθικλμνξοπρστ", "აბგდევზთიკლმნოპჟრ"]


def made_up_languages(n, chance):
    """Word lists, each half shared with the language before it in its script."""
    lists = []
    for k in range(n):
        letters = SCRIPTS[k % len(SCRIPTS)]
        own = ["".join(chance.choices(letters, k=chance.randint(2, 9))) for _ in range(300)]
        shared = lists[k - len(SCRIPTS)][:150] if k >= len(SCRIPTS) else []
        lists.append(own[: 300 - len(shared)] + shared)
    return {f"l{k:02}": words for k, words in enumerate(lists)}


def test_sixty_languages_keep_all_their_passages(spark):
    chance = random.Random(6)
    words = made_up_languages(60, chance)
    rows = [
        (100 * k + n, " ".join(chance.choices(words[lang], k=300)), lang)
        for k, lang in enumerate(words)
        for n in range(100)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    training = dict(langid.learn_languages(docs))
    assert sorted(training) == sorted(words)
    # 64 passages of 1000 characters, of two or three bytes in most scripts.
    assert min(map(len, training.values())) > 64 * 950
    parser = Parser(training)
    assert 0 < len(parser._tables) < len(parser.automata)
    assert sum(t.nbytes for t in parser._tables.values()) <= langid.TABLE_BYTES
    cases = [(lang, " ".join(chance.choices(words[lang], k=12))) for lang in words for _ in range(10)]
    found = parser.identify([t for _, t in cases])
    right = sum(f[0] == lang for f, (lang, _) in zip(found, cases))
    assert right >= 0.97 * len(cases)


def test_held_out_languages_are_not_used(documents):
    docs, _ = corpus(documents)
    turned = docs.selectExpr(
        "doc_id", "text",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'zz', lang) as lang", "source", "n_chars",
    )
    assert langid.learn_languages(docs) == langid.learn_languages(turned)


@pytest.mark.parametrize("text, expected", [("Ab-C\t1é", b"ab c \xc3\xa9"), ("", b""), ("…", "…".encode())])
def test_normal(text, expected):
    assert normal(text) == expected
