import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from noticehouse.llm import cross_tokens
from noticehouse.llm.common import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_bytes():
    """The byte-level alphabet, written out as its definition has it."""
    shown = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    table, extra = {}, 0
    for byte in range(256):
        if byte in shown:
            table[chr(byte)] = byte
        else:
            table[chr(256 + extra)] = byte
            extra += 1
    return table


def brute(texts, tools):
    """Whole texts, all pairs of tokens compared by their byte ranges."""
    a, b = tools
    table, per_doc = plain_bytes(), []
    for text in texts:
        links, groups, n = [], [], (0, 0)
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            xs = [bytes(table[c] for c in a.id_to_token(k)) for k in x]
            ys = [
                bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k)
                else b.id_to_piece(k).replace("▁", " ").encode()
                for k in y
            ]
            raw = (" " + text).encode()
            if b"".join(xs) == raw == b"".join(ys):
                n = (len(x), len(y))
                xe, ye = np.cumsum([len(s) for s in xs]).tolist(), np.cumsum([len(s) for s in ys]).tolist()
                xb, yb = [0, *xe[:-1]], [0, *ye[:-1]]
                links = [
                    (x[i], y[j])
                    for i in range(len(x))
                    for j in range(len(y))
                    if xb[i] < ye[j] and yb[j] < xe[i]
                ]
                start = 0
                for cut in sorted(set(xe) & set(ye)):
                    groups.append(
                        ",".join(str(k) for k, e in zip(x, xe) if start < e <= cut)
                        + "|"
                        + ",".join(str(k) for k, e in zip(y, ye) if start < e <= cut)
                    )
                    start = cut
        per_doc.append((n, links, groups))
    counts = Counter(pair for _, links, _ in per_doc for pair in set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (n_a, n_b), links, groups in per_doc:
        out.append(
            (
                n_a, n_b, len(groups), len(links),
                sum(counts[p] == best[p[0]] for p in links),
                sum(counts[p] for p in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
        )
    return out


def result(df, **options):
    rows = cross_tokens.align_documents(df, A, B, **options).collect()
    return sorted(
        (str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows
    )


def expected(rows, tools):
    return sorted((str(i), *own) for (i, _), own in zip(rows, brute([t for _, t in rows], tools)))


TEXTS = [
    "Hello world", "hello  world\n\nagain", " leading", "trailing  ", "\ttab\tand\nline ", None, "", " ", "\n",
    "<|endoftext|> and <s> </s> <unk> are text", "Éa ça là: 日本語 \U0001f600\U0001f600 ½ﬁ", "x\r\ny;\r\nz", "a  b 　c d",
    "under▁score", "nul\x00byte", "don't can't I'll 12345 3.14", "a" * 300, "<0x41> <0x0A>", "​zero", "...!!! ??",
]


def test_cases(documents, tools, clashing):
    rows = list(enumerate(TEXTS)) + [(3, "Hello world"), (None, "Hello world"), (3, "Hello world")]
    found = result(documents(*rows, **clashing))
    assert found == expected(rows, tools)


@pytest.mark.parametrize("words,fan", [(1 << 20, 64), (40, 2)])
def test_random_texts_in_few_and_many_runs(documents, tools, words, fan):
    rng = random.Random(5)
    pool = ["the", "Than", "thé", "in,", "ofrebleinre", "the.", "of", "Zürich", "x1y2", "▁", "a\rb", "日本"]
    gaps = [" ", " ", " ", "  ", "\n", "\n ", "\t", " \n"]
    rows = [
        (k, "".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randrange(40))) + rng.choice(["", "end"]))
        for k in range(120)
    ]
    assert result(documents(*rows), run_words=words, fan=fan) == expected(rows, tools)


def test_words_of_a_text_are_those_of_the_whole(tools):
    """Any mix of characters, cut or not, is encoded as the libraries encode it."""
    rng = random.Random(9)
    assert cross_tokens.Aligner(A, B)._quick is not None
    alphabet = "ab E1.,'\n\t é日\U0001f600-_()<>|$\"" + " " * 8
    own = cross_tokens.Aligner(A, B)
    a, b = tools
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 30)))
        words = own.words(text)
        own.clear()
        if own.plain(text):
            own.learn(list(dict.fromkeys(words)))
        else:
            own.learn_text(words[0])
        groups = ";".join(own.groups[own.places[w]] for w in words)
        ids = [[int(k) for g in groups.split(";") for k in g.split("|")[s].split(",")] for s in (0, 1)]
        assert ids == [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)], repr(text)


def test_very_long_text_and_empty_table(documents, tools):
    long = "word and other " * 40_000
    rows = [(1, long), (2, "word"), (3, "y" * 20_000)]
    found = result(documents(*rows))
    x, y = tools[0].encode(" " + long, add_special_tokens=False).ids, tools[1].encode(long)
    assert found[0][:3] == ("1", len(x), len(y))
    assert found[1:] == [r for r in result(documents(*rows), run_words=1000) if r[0] != "1"]
    assert result(documents()) == []


def test_groups_are_given_on_demand(documents):
    row = cross_tokens.align_documents(documents("Hello there"), A, B, groups=True).head()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
