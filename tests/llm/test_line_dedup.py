import random
from collections import defaultdict

import pytest

from noticehouse.llm import line_dedup

SPACE = " \t\n\x0b\f\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, least_documents=2, least_length=10):
    """What the rule says, document by document; a null id is one id, the largest."""
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key := key_of(line)) >= least_length:
                holders[key].add((doc is None, doc or 0))
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        me = (doc is None, doc or 0)
        kept = [
            s
            for s in lines
            if len(holders[key_of(s)]) < least_documents or min(holders[key_of(s)]) == me
        ]
        found.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=str)


def result(df, **options):
    rows = line_dedup.drop_repeated_lines(df, **options).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows), key=str)


def test_rules(documents, clashing):
    rows = [
        (3, "Shared line here\nown line of three\n\tshared LINE here \x0b"),
        (1, " SHARED line HERE\r\n"),
        (2, "short\nshared line here\nshort"),
        (4, "short\nÉcouter le monde\nécouter le monde"),
        (5, "Écouter le monde"),
        (6, None),
        (7, ""),
        (None, "shared line here"),
        (8, " shared line here"),
        (9, "\U0001f600" * 10),
        (10, "\U0001f600" * 10 + "\n" + "\U0001f600" * 9),
        (11, "\U0001f600" * 9),
    ]
    assert result(documents(*rows, **clashing)) == brute(rows)


def test_repeated_rows_and_ids(documents):
    rows = [(1, "a line of text\nother"), (1, "a line of text\nother"), (1, "a line of text"),
            (2, "a line of text"), (2, "a line of text"), (None, "null line of text"), (None, "null line of text")]
    assert result(documents(*rows)) == brute(rows)


@pytest.mark.parametrize("least", [2, 3])
def test_random_texts(documents, least):
    rng = random.Random(least)
    pool = [f"line number {k:02d}" for k in range(30)] + ["", "x", "  LINE NUMBER 03 "]
    rows = [
        (rng.choice([*range(25), None]), "\n".join(rng.choices(pool, k=rng.randrange(12))))
        for _ in range(80)
    ]
    assert result(documents(*rows), least_documents=least) == brute(rows, least)


def test_long_text_and_empty_table(documents):
    many = "\n".join(f"a line with number {k % 5000}" for k in range(60_000))
    rows = [(1, "a line with number 7"), (2, many), (3, "x" * 2_000_000)]
    assert result(documents(*rows)) == brute(rows)
    assert result(documents()) == []


def test_hot_line_is_one_row_per_task(documents):
    """A line of every document is counted before the shuffle."""
    rows = [(k, f"a very common line\nown line number {k}") for k in range(2000)]
    assert result(documents(*rows)) == brute(rows)
    plan = line_dedup.repeated_lines(documents(*rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 4
