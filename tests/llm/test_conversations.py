import hashlib
import random
import zlib
from itertools import product as choices

import pytest

from noticehouse.llm import conversations as C

SPACE = " \t\n\x0b\f\r"
ROWS = "conv_id bigint, turn bigint, role string, text string"


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        said = text.rstrip(SPACE)
        if not said:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif said[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append("")
        seen.add((role, text))
    return found


NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute(rows, costs):
    """Cheapest edits row by row, whole strings kept for each state."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    found = faults(rows)

    # Every string that may still win is kept: prefixes are compared only at the end.
    states = {"": [(0, "", ())]}
    for (_, role, text), fault in zip(rows, found):
        new = {}
        for state, ways in states.items():
            for cost, audit, out in ways:
                more = [(state, cost, audit, out)]
                for _ in range(3):
                    s, c, a, o = more[-1]
                    put = "a" if s == "u" else "u"
                    name = "assistant" if put == "a" else "user"
                    more.append((NEXT[s, put], c + costs.insert, a + "I", (*o, (name, ""))))
                for s, c, a, o in more:
                    new.setdefault(s, []).append((c + costs.delete, a + "D", o))
                    if fault in ("blank", "duplicate"):
                        continue
                    extra = costs.truncated if fault == "truncated" else 0
                    if (s, role[:1]) in NEXT:
                        new.setdefault(NEXT[s, role[:1]], []).append((c + costs.keep + extra, a + "K", (*o, (role, text))))
                    put = "a" if s == "u" else "u"
                    name = "assistant" if put == "a" else "user"
                    new.setdefault(NEXT[s, put], []).append((c + costs.rerole + extra, a + "R", (*o, (name, text))))
        states = {s: sorted(set(w), key=lambda x: x[:2])[:40] for s, w in new.items()}
    ends = []
    for state, ways in states.items():
        for cost, audit, out in ways:
            while state not in ("", "a"):
                put = "a" if state == "u" else "u"
                cost, audit = cost + costs.insert, audit + "I"
                out = (*out, ({"a": "assistant", "u": "user"}[put], ""))
                state = NEXT[state, put]
            ends.append((cost, audit, out))
            state = next(s for s, w in states.items() if w is ways)
    cost, audit, out = min(ends, key=lambda x: x[:2]) if rows else (0, "", ())
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(found.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    )


def damaged(rows):
    """By the rule, in plain Python: rows of each conversation after damage."""
    out = {}
    for conv, turn, role, text in rows:
        one = lambda v: " " if v is None else str(v)
        role, text = one(role), one(text)
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def result(df, **options):
    rows = C.repair_conversations(C.damage(df), **options).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
        for r in rows
    }


def expected(rows, costs=C.Costs()):
    return {conv: brute(own, costs) for conv, own in damaged(rows).items()}


def talk(rng, conv, length):
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None]
    texts = ["Yes.", "No", "", " \n", None, "Who?", "cut off ", "Done! ", "again."]
    turn = 0
    for _ in range(length):
        turn += rng.choice([0, 1, 1, 1, 3])
        yield conv, rng.choice([turn] * 9 + [None]), rng.choice(roles[:5] if rng.random() < 0.9 else roles), rng.choice(texts)


@pytest.mark.parametrize("costs", [C.Costs(), C.Costs(0, 3, 4, 1, 2), C.Costs(1, 1, 1, 1, 1)])
def test_random_conversations(spark, costs):
    rng = random.Random(7)
    rows = [row for conv in range(120) for row in talk(rng, conv, rng.randrange(1, 14))]
    rows += list(talk(rng, None, 6))
    df = spark.createDataFrame(rows, ROWS)
    found, right = result(df, costs=costs), expected(rows, costs)
    assert found.keys() == right.keys()
    wrong = [(k, found[k], right[k]) for k in right if found[k] != right[k]]
    assert not wrong


def test_conversations_over_partitions_and_blocks(spark):
    """A long conversation cut into blocks and partitions gives the same."""
    rng = random.Random(3)
    rows = list(talk(rng, 5, 150)) + [row for conv in (4, 6) for row in talk(rng, conv, 5)]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    right = expected(rows)
    assert result(df, block_rows=7) == right
    assert result(df) == right
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(df, block_rows=11) == right
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_rows_are_few_in_any_shuffle(spark):
    rows = [(1, 0, "user", "Hot row.")] * 3000 + [(1, 1, "assistant", "Yes.")]
    assert result(spark.createDataFrame(rows, ROWS)) == expected(rows)


def test_empty_table_dropped_rows_and_extra_columns(spark):
    empty = spark.createDataFrame([], ROWS)
    assert result(empty) == {}
    dropped = next(k for k in range(999) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], ROWS).selectExpr("*", "1 as copies", "'x' as start")
    nothing = hashlib.sha256(b"").hexdigest()
    assert result(df) == {dropped: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 600_000 + "."), (1, 1, "assistant", "x" * 3_000_000)]
    assert result(spark.createDataFrame(rows, ROWS)) == expected(rows)


def test_re_pair_gives_back_the_sequences():
    rng = random.Random(1)
    sequences = [bytes(rng.choices(range(4), k=rng.randrange(40))) for _ in range(200)] + [bytes(50), b""]
    rules, made = C.re_pair(sequences, 9)

    def expand(symbol):
        if symbol < 9:
            return bytes([symbol])
        return b"".join(map(expand, rules[symbol - 9]))

    assert [b"".join(map(expand, m)) for m in made] == sequences
    pairs = [p for m in made for p in zip(m, m[1:])]
    assert len(rules) > 10 and sum(map(len, made)) < sum(map(len, sequences)) / 2
    assert all(pairs.count(p) < 3 for p in set(pairs))


def test_products_are_associative_and_equal_the_chain():
    costs = C.Costs(0, 2, 3, 1, 2)
    letters = [C.symbol_matrix(s, costs) for s in range(9)]
    for a, b, c in choices(range(9), repeat=3):
        left = C.product(C.product(letters[a], letters[b]), letters[c])
        right = C.product(letters[a], C.product(letters[b], letters[c]))
        assert left.cost == right.cost and left.rank == right.rank


def test_turns(spark):
    rows = [(1, 0, "user", "Hello there."), (1, 1, "assistant", "Hi.")]
    typed = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 as copies")
    turns = C.repaired_turns(C.repair_segments(typed)).orderBy("position").collect()
    assert [(t.role, t.text) for t in turns] == [("user", "Hello there."), ("assistant", "Hi.")]
