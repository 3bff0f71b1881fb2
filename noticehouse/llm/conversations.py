"""Conversation repair by dynamic programming over grammar-compressed sequences.

A row of a conversation is a symbol: the class of its role, and whether it is cut
off or has to go. What edits a stretch of rows needs is a min-plus transfer matrix
over the states of the role grammar ``(s?(ua)+)?``: entry (i, j) is the cheapest
cost from state i to state j, with the ASCII-least string of edits. Stretches follow
each other by a matrix product.

Re-Pair replaces the most frequent pair of symbols by a new one, again and again, in
all distinct sequences of a block of conversations at once. Each rule gets one matrix,
the product of its two halves, bottom-up; so what conversations have in common is
worked out once. The string of an entry is a rope: the state in the middle, and with
it an entry of either half.

Ties need no strings: all entries of one start state consume the same rows and end
in a row's letter, so none is a prefix of another, and the order of two products is
the order of their first halves, then of their second. A matrix keeps the rank of its
entries instead.

Rows are range-partitioned by conversation and turn, so that a hot conversation is
spread over tasks. A conversation inside one partition is settled there. The
stretches of those that cross a border, or are too long for one block, are combined
by their matrices, one narrow row each, and then written with the states they meet.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticehouse.llm.common import stage

SPACE = " \t\n\x0b\f\r"
ENDS = ".!?"
#: A block of conversations shares a grammar; a longer conversation is cut.
BLOCK_ROWS, BLOCK_CHARS = 50_000, 16 << 20

# States of the role grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTED = (START, ASSISTANT)
#: Symbols: three initials and any other, each whole or cut off, and rows that must go.
INITIALS = "sua"
OTHER, CUT, GONE = 3, 4, 8
FAR = 1 << 60

ROWS = "conv_id bigint, turn bigint, role string, start string, text string, later boolean, copies bigint"
STATS = ["n_rows", "blank", "duplicate", "truncated", "illegal", "gaps"]
SEGMENTS = (
    "conv_id bigint, part int, seq int, whole boolean, n_rows bigint, blank bigint, duplicate bigint,"
    " truncated bigint, illegal bigint, n_turns bigint, first_turn bigint, last_turn bigint,"
    " first_role string, last_role string, cost bigint, audit string, symbols binary,"
    " roles array<string>, texts array<string>, repaired_sha256 string"
)


@dataclass(frozen=True)
class Costs:
    """``truncated`` is added for each cut-off row that is not deleted."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


@dataclass
class Matrix:
    """Entry (i, j) is at 4 i + j. ``middle`` is set for rules, ``text`` for symbols."""

    cost: list[int]
    rank: list[int]
    middle: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)


def after(state: int, initial: int) -> int | None:
    """The state after a role, none if the grammar does not allow it there."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def wanted(state: int) -> int:
    """The one role, user or assistant, that may come next."""
    return 2 if state == USER else 1


def symbol_matrix(symbol: int, costs: Costs) -> Matrix:
    """Any inserts, then what may happen to one row."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for start in STATES:
        state, spent, text = start, 0, ""
        for _ in STATES:  # more inserts than states only go round
            options = [(state, costs.delete, "D")]
            if symbol < GONE:
                extra = costs.truncated if symbol & CUT else 0
                kept = after(state, symbol & 3)
                if kept is not None:
                    options.append((kept, costs.keep + extra, "K"))
                options.append((after(state, wanted(state)), costs.rerole + extra, "R"))
            for end, cost, letter in options:
                way = (spent + cost, text + letter)
                found[start, end] = min(found.get((start, end), way), way)
            state, spent, text = after(state, wanted(state)), spent + costs.insert, text + "I"
    cells = [found.get((i, j), (FAR, "")) for i in STATES for j in STATES]
    rank = [0] * 16
    for i in STATES:
        row = sorted((cells[4 * i + j][1], j) for j in STATES if cells[4 * i + j][0] < FAR)
        for place, (_, j) in enumerate(row):
            rank[4 * i + j] = place
    return Matrix([c for c, _ in cells], rank, text=[t for _, t in cells])


def product(left: Matrix, right: Matrix) -> Matrix:
    """One stretch after another, in min-plus algebra with ties to the least string."""
    made = Matrix([FAR] * 16, [0] * 16, [0] * 16)
    for i in STATES:
        order = []
        for j in STATES:
            best = min(
                (
                    (left.cost[4 * i + m] + right.cost[4 * m + j], left.rank[4 * i + m], right.rank[4 * m + j], m)
                    for m in STATES
                    if left.cost[4 * i + m] < FAR and right.cost[4 * m + j] < FAR
                ),
                default=None,
            )
            if best:
                made.cost[4 * i + j], made.middle[4 * i + j] = best[0], best[3]
                order.append((best[1], best[2], j))
        for place, (_, _, j) in enumerate(sorted(order)):
            made.rank[4 * i + j] = place
    return made


def closing(state: int, costs: Costs) -> tuple[int, str]:
    """Inserts after the last row."""
    spent, text = 0, ""
    while state not in ACCEPTED:
        state, spent, text = after(state, wanted(state)), spent + costs.insert, text + "I"
    return spent, text


def re_pair(sequences: Iterable[bytes], first: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules ``first``, ``first`` + 1, ... as pairs of symbols, and the sequences in them.

    The most frequent pair is replaced while any occurs twice.
    """
    symbols: list[int] = []
    for sequence in sequences:
        symbols.extend(sequence)
        symbols.append(-1)  # never part of a pair
    ends = len(symbols)
    before, behind = list(range(-1, ends - 1)), list(range(1, ends + 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    for at in range(ends - 1):
        if symbols[at] >= 0 and symbols[at + 1] >= 0:
            places[symbols[at], symbols[at + 1]].add(at)
    queue = [(-len(found), pair) for pair, found in places.items()]
    heapq.heapify(queue)
    rules: list[tuple[int, int]] = []

    def forget(at: int, to: int) -> None:
        if at >= 0 and to < ends and symbols[at] >= 0 and symbols[to] >= 0:
            places[symbols[at], symbols[to]].discard(at)

    while queue:
        count, pair = heapq.heappop(queue)
        found = places[pair]
        if len(found) != -count:
            if len(found) > 1:
                heapq.heappush(queue, (-len(found), pair))
            continue
        if len(found) < 2:
            break
        new, touched = first + len(rules), set()
        replaced = 0
        for at in sorted(found):
            to = behind[at]
            if (symbols[at], symbols[to] if to < ends else -1) != pair or at not in places[pair]:
                continue
            left, right = before[at], behind[to]
            forget(left, at)
            forget(at, to)
            forget(to, right)
            symbols[at], symbols[to] = new, -2
            behind[at] = right
            if right < ends:
                before[right] = at
            for a, b in ((left, at), (at, right)):
                if a >= 0 and b < ends and symbols[a] >= 0 and symbols[b] >= 0:
                    places[symbols[a], symbols[b]].add(a)
                    touched.add((symbols[a], symbols[b]))
            replaced += 1
        if replaced:
            rules.append(pair)
        for other in touched:
            if len(places[other]) > 1:
                heapq.heappush(queue, (-len(places[other]), other))
        if len(found := places[pair]) > 1:
            heapq.heappush(queue, (-len(found), pair))
    made: list[list[int]] = [[]]
    for symbol in symbols:
        if symbol == -1:
            made.append([])
        elif symbol >= 0:
            made[-1].append(symbol)
    return rules, made[:-1]


class Grammar:
    """The rules of some sequences, with a matrix each."""

    def __init__(self, sequences: Iterable[bytes], costs: Costs):
        self.costs = costs
        distinct = list(dict.fromkeys(sequences))
        self.rules, made = re_pair(distinct, GONE + 1)
        self.made = dict(zip(distinct, made))
        self.matrices = [symbol_matrix(s, costs) for s in range(GONE + 1)]
        for a, b in self.rules:
            self.matrices.append(product(self.matrices[a], self.matrices[b]))
        self._ropes: dict[tuple[int, int], str] = {}

    def rope(self, symbol: int, cell: int) -> str:
        """The string of an entry, put together from the halves of its rule."""
        todo = [(symbol, cell)]
        while todo:
            at = todo[-1]
            if at in self._ropes:
                todo.pop()
                continue
            matrix = self.matrices[at[0]]
            if matrix.text:
                self._ropes[at] = matrix.text[at[1]]
                continue
            (i, j), m = divmod(at[1], 4), matrix.middle[at[1]]
            a, b = self.rules[at[0] - GONE - 1]
            halves = ((a, 4 * i + m), (b, 4 * m + j))
            missing = [h for h in halves if h not in self._ropes]
            if missing:
                todo.extend(missing)
            else:
                self._ropes[at] = "".join(self._ropes[h] for h in halves)
        return self._ropes[symbol, cell]

    def ways(self, sequence: bytes, start: int) -> tuple[dict[int, tuple[int, int]], list[dict[int, int]]]:
        """Cost and rank of each end state reached, and the state before at each step."""
        here, steps = {start: (0, 0)}, []
        for symbol in self.made[sequence]:
            matrix, reached = self.matrices[symbol], {}
            for j in STATES:
                options = [
                    (cost + matrix.cost[4 * m + j], rank, matrix.rank[4 * m + j], m)
                    for m, (cost, rank) in here.items()
                    if matrix.cost[4 * m + j] < FAR
                ]
                if options:
                    reached[j] = min(options)
            order = sorted(reached, key=lambda j: reached[j][1:3])
            here = {j: (reached[j][0], place) for place, j in enumerate(order)}
            steps.append({j: way[3] for j, way in reached.items()})
        return here, steps

    def audit(self, sequence: bytes, steps: list[dict[int, int]], end: int) -> str:
        parts = []
        for symbol, step in zip(reversed(self.made[sequence]), reversed(steps)):
            parts.append(self.rope(symbol, 4 * step[end] + end))
            end = step[end]
        return "".join(reversed(parts))

    def cheapest(self, sequence: bytes) -> tuple[int, str]:
        """Cost and edits of a whole conversation."""
        ends, steps = self.ways(sequence, START)
        closed = {j: closing(j, self.costs) for j in ends}
        end = min(ends, key=lambda j: (ends[j][0] + closed[j][0], ends[j][1]))
        return ends[end][0] + closed[end][0], self.audit(sequence, steps, end) + closed[end][1]

    def between(self, sequence: bytes, start: int, end: int) -> str:
        """Edits of a stretch from one state to another."""
        return self.audit(sequence, self.ways(sequence, start)[1], end)

    def summary(self, sequence: bytes) -> Matrix:
        made = Matrix([FAR] * 16, [0] * 16)
        for i in STATES:
            for j, (cost, rank) in self.ways(sequence, i)[0].items():
                made.cost[4 * i + j], made.rank[4 * i + j] = cost, rank
        return made


def apply_edits(
    audit: str, roles: list[str], texts: list[str], state: int = START
) -> tuple[list[str], list[str]]:
    """The rows that edits leave, from a state on."""
    new_roles, new_texts, at = [], [], 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text = roles[at], texts[at]
            state = after(state, INITIALS.index(role[:1]))
        else:
            initial = wanted(state)
            role = "assistant" if initial == 2 else "user"
            text = texts[at] if letter == "R" else ""
            state = after(state, initial)
        at += letter != "I"
        new_roles.append(role)
        new_texts.append(text)
    return new_roles, new_texts


def digest(roles: list[str], texts: list[str]) -> str:
    lines = "\n".join(f"{r}:{t}" for r, t in zip(roles, texts))
    return hashlib.sha256(lines.encode()).hexdigest()


class Segment:
    """Consecutive rows of one conversation."""

    def __init__(self, conv_id: int | None, opened: bool):
        self.conv_id, self.opened = conv_id, opened
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.symbols = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.chars = 0
        self.n_turns, self.first_turn, self.last_turn = 0, None, None

    def add(self, turn: int | None, role: str, text: str, later: bool, copies: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.n_turns = turn, self.n_turns + 1
        said, initial = text.rstrip(SPACE), role[:1]
        known = max(INITIALS.find(initial), 0) if initial and initial in INITIALS else OTHER
        if self.roles and self.roles[-1][:1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += copies - 1  # no role may follow itself
        if not said:
            self.blank += copies
            self.symbols += bytes([GONE]) * copies
        else:
            fresh = 0 if later else 1
            self.duplicate += copies - fresh
            if fresh:
                cut = said[-1] not in ENDS
                self.truncated += cut
                self.symbols.append(known | (CUT if cut else 0))
            self.symbols += bytes([GONE]) * (copies - fresh)
        self.roles += [role] * copies
        self.texts += [text] * copies
        self.chars += len(text) * copies

    def record(self, part: int, seq: int, grammar: Grammar | None, whole: bool) -> dict:
        row = {
            "conv_id": self.conv_id, "part": part, "seq": seq, "whole": whole,
            "n_rows": len(self.roles), "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "n_turns": self.n_turns,
            "first_turn": self.first_turn, "last_turn": self.last_turn,
        }
        if not whole:
            ends = (self.roles[0], self.roles[-1]) if self.roles else (None, None)
            return row | {
                "first_role": ends[0], "last_role": ends[1], "symbols": bytes(self.symbols),
                "roles": self.roles, "texts": self.texts,
            }
        cost, audit = grammar.cheapest(bytes(self.symbols))
        roles, texts = apply_edits(audit, self.roles, self.texts)
        return row | {
            "cost": cost, "audit": audit, "roles": roles, "texts": texts,
            "repaired_sha256": digest(roles, texts),
        }


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch become one, so that a hot row is few before the shuffle."""
    for batch in batches:
        keys = batch.schema.names[:-1]
        table = pa.Table.from_batches([batch]).group_by(keys).aggregate([("copies", "sum")])
        table = table.rename_columns([*keys, "copies"]) if table.schema.names[-1] == "copies_sum" else table
        yield from table.select(batch.schema.names).cast(batch.schema).to_batches()


def _segments(schema: pa.Schema, costs: Costs, block_rows: int, block_chars: int):
    """Sorted rows of a partition to whole conversations, and stretches of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        done: list[Segment] = []
        rows = chars = 0
        now: Segment | None = None

        def flush(stretches: list[Segment]) -> pa.RecordBatch:
            nonlocal seq, rows, chars
            grammar = Grammar((bytes(s.symbols) for s in done), costs)
            records = []
            for segment, whole in [*((s, True) for s in done), *((s, False) for s in stretches)]:
                records.append(segment.record(part, seq, grammar, whole))
                seq += 1
            done.clear()
            rows = chars = 0
            return pa.RecordBatch.from_pylist(records, schema)

        for batch in batches:
            columns = batch.to_pydict()
            names = ("conv_id", "turn", "role", "text", "later", "copies")
            for conv_id, turn, role, text, later, copies in zip(*(columns[n] for n in names)):
                if now is None:
                    now = Segment(conv_id, True)
                elif conv_id != now.conv_id:
                    if now.opened:
                        yield flush([now])
                    else:
                        done.append(now)
                        rows, chars = rows + len(now.roles), chars + now.chars
                        if rows >= block_rows or chars >= block_chars:
                            yield flush([])
                    now = Segment(conv_id, False)
                if copies:
                    now.add(turn, role, text, later, copies)
                if len(now.roles) >= block_rows or now.chars >= block_chars:
                    yield flush([now])
                    now = Segment(conv_id, True)
        if now is not None:
            yield flush([now])

    return run


def _chain(segments: pd.DataFrame, costs: Costs) -> pd.DataFrame:
    """The states at which the stretches of a conversation meet, and its figures."""
    segments = segments.sort_values(["part", "seq"], ignore_index=True)
    cells = [list(map(int, c)) for c in segments["cells"]]
    ranks = [list(map(int, r)) for r in segments["ranks"]]
    here, steps = {START: (0, 0)}, []
    for cost, rank in zip(cells, ranks):
        reached = {}
        for j in STATES:
            options = [
                (spent + cost[4 * m + j], order, rank[4 * m + j], m)
                for m, (spent, order) in here.items()
                if cost[4 * m + j] < FAR
            ]
            if options:
                reached[j] = min(options)
        order = sorted(reached, key=lambda j: reached[j][1:3])
        here = {j: (reached[j][0], place) for place, j in enumerate(order)}
        steps.append({j: way[3] for j, way in reached.items()})
    closed = {j: closing(j, costs)[0] for j in here}
    end = min(here, key=lambda j: (here[j][0] + closed[j], here[j][1]))
    total = here[end][0] + closed[end]
    states = [end]
    for step in reversed(steps):
        states.append(step[states[-1]])
    states.reverse()

    figures = {n: int(segments[n].sum()) for n in ("n_rows", "blank", "duplicate", "truncated", "illegal")}
    turns, low, high, last_role = 0, None, None, None
    for s in segments.itertuples():
        if not pd.isna(s.first_turn):
            turns += int(s.n_turns) - (high is not None and high == int(s.first_turn))
            low, high = int(s.first_turn) if low is None else low, int(s.last_turn)
        if s.n_rows:
            if last_role is not None and last_role[:1] + s.first_role[:1] not in ("su", "ua", "au"):
                figures["illegal"] += 1
            last_role = s.last_role
    figures["gaps"] = 0 if low is None else high - low + 1 - turns
    made = segments[["part", "seq"]].assign(
        start=states[:-1], end=states[1:], last=[*[False] * (len(steps) - 1), True], cost=total
    )
    return made.assign(**{n: figures[n] for n in STATS})


def repair_segments(
    rows: DataFrame,
    costs: Costs = Costs(),
    block_rows: int = BLOCK_ROWS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Repaired conversations in pieces: ``conv_id``, ``part``, ``seq``, the ``roles``
    and ``texts`` that stay, the edits of the piece, and the figures of the whole
    conversation. Pieces of one conversation follow each other by ``part`` and ``seq``.

    ``rows`` holds ``conv_id``, ``turn``, ``role``, ``text`` and ``copies``: how often
    the row stands. A conversation of rows that stand nowhere is an empty one.
    """
    if min(costs.insert, costs.delete) <= 0:
        raise ValueError("inserting and deleting must cost something")
    blank = F.lit(" ")
    typed = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), blank).alias("role"),
        F.coalesce(F.col("text"), blank).alias("text"),
        F.col("copies").cast("bigint").alias("copies"),
    ).select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    said = ["conv_id", "role", "h1", "h2"]
    # Texts a conversation has at more than one turn, with the first.
    first = F.min(F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn")))
    last = F.max(F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn")))
    again = (
        typed.where("copies > 0")
        .groupBy(*said)
        .agg(first.alias("first"), last.alias("last"))
        .where("first <> last")
    )
    again = stage(again.select(*said, "first"), "repeated-turns")
    same = F.col("r.conv_id").eqNullSafe(F.col("a.conv_id"))
    for name in said[1:]:
        same = same & (F.col(f"r.{name}") == F.col(f"a.{name}"))
    own = F.struct(F.col("r.turn").isNotNull().alias("set"), F.col("r.turn").alias("turn"))
    marked = typed.alias("r").join(again.alias("a"), same, "left").select(
        "r.conv_id",
        "r.turn",
        "r.role",
        # Orders texts like the texts themselves, and keeps range bounds small.
        F.left(F.col("r.text"), F.lit(64)).alias("start"),
        "r.text",
        F.coalesce(F.col("a.first") < own, F.lit(False)).alias("later"),
        "r.copies",
    )
    ordered = (
        marked.mapInArrow(_combine, ROWS)
        .repartitionByRange("conv_id", "turn", "role", "start")
        .groupBy("conv_id", "turn", "role", "start", "text", "later")
        .agg(F.sum("copies").alias("copies"))
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    schema = _arrow(SEGMENTS)
    made = stage(
        ordered.mapInArrow(_segments(schema, costs, block_rows, block_chars), SEGMENTS),
        "conversation-segments",
    )
    spread = F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns")
    report = ["conv_id", "part", "seq", "roles", "texts", "audit", "cost", *STATS]
    whole = made.where("whole").withColumn("gaps", F.coalesce(spread, F.lit(0)))
    whole = whole.select(*report, F.lit(True).alias("last"), "repaired_sha256")
    return whole.unionByName(_joined(made.where("not whole"), costs, report))


def _joined(opened: DataFrame, costs: Costs, report: list[str]) -> DataFrame:
    """The stretches of conversations that lie in more than one."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences = batch.column("symbols").to_pylist()
            grammar = Grammar(sequences, costs)
            found = [grammar.summary(s) for s in sequences]
            others = [n for n in batch.schema.names if n != "symbols"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in others),
                    pa.array([m.cost for m in found], pa.list_(pa.int64())),
                    pa.array([m.rank for m in found], pa.list_(pa.int64())),
                ],
                names=[*others, "cells", "ranks"],
            )

    narrow = opened.select(
        "conv_id", "part", "seq", "n_rows", "blank", "duplicate", "truncated", "illegal",
        "n_turns", "first_turn", "last_turn", "first_role", "last_role", "symbols",
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name != "symbols")
    summed = narrow.mapInArrow(summaries, f"{fields}, cells array<bigint>, ranks array<bigint>")
    figures = ", ".join(f"{n} bigint" for n in STATS)
    chained = summed.groupBy("conv_id").applyInPandas(
        lambda pdf: _chain(pdf, costs),
        f"part int, seq int, start int, end int, last boolean, cost bigint, {figures}",
    )
    chained = stage(chained, "conversation-chains")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            grammar = Grammar([r["symbols"] for r in rows], costs)
            for row in rows:
                audit = grammar.between(row["symbols"], row["start"], row["end"])
                if row["last"]:
                    audit += closing(row["end"], costs)[1]
                edited = apply_edits(audit, row["roles"], row["texts"], row["start"])
                row["roles"], row["texts"] = edited
                row["audit"] = audit
            yield pa.RecordBatch.from_pylist(rows, out)

    met = opened.select("conv_id", "part", "seq", "symbols", "roles", "texts").join(chained, ["part", "seq"])
    fields = ", ".join(
        ["conv_id bigint, part int, seq int, roles array<string>, texts array<string>, audit string",
         "cost bigint", figures, "last boolean"]
    )
    out = _arrow(fields)
    written = stage(met.mapInArrow(write, fields), "conversation-pieces")
    return written.withColumn("repaired_sha256", F.lit(None).cast("string"))


def repair_conversations(rows: DataFrame, costs: Costs = Costs(), **blocks: int) -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    Rows go by turn, nulls first, ties by role and text. Null roles and texts are one
    space; a null ``conv_id`` is a conversation of its own; equal rows are repeats of
    each other, whichever comes first. An empty role fits nowhere. A conversation
    without rows gives zeros, no edits and the hash of nothing; an empty table gives
    no row. Other columns are not read.
    """
    pieces = repair_segments(rows, costs, **blocks)
    report = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    settled = pieces.where(F.col("repaired_sha256").isNotNull()).select(*report)
    schema = pieces.select(*report).schema
    out = _arrow(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema))

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A digest takes its text in order, one piece in memory at a time."""
        state, audits, begun = hashlib.sha256(), [], False
        for batch in batches:
            for row in batch.to_pylist():
                for role, text in zip(row["roles"], row["texts"]):
                    state.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
                audits.append(row["audit"])
                if row["last"]:
                    made = {n: row.get(n) for n in report}
                    made |= {"audit": "".join(audits), "repaired_sha256": state.hexdigest()}
                    yield pa.RecordBatch.from_pylist([made], out)
                    state, audits, begun = hashlib.sha256(), [], False

    rest = (
        pieces.where(F.col("repaired_sha256").isNull())
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "seq")
        .mapInArrow(streamed, schema)
    )
    return settled.unionByName(rest)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """The rows of repaired conversations in place: ``conv_id``, ``part``, ``seq``,
    ``position``, ``role`` and ``text``, in this order."""
    zipped = F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))
    return pieces.select("conv_id", "part", "seq", F.posexplode(zipped).alias("position", "row")).select(
        "conv_id", "part", "seq", "position", "row.role", "row.text"
    )


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults, by the crc32 of ``conv_id:turn`` modulo 20: 0 leaves the row
    out (no copies), 1 empties its text, 2 takes its sentence ends, 3 repeats it, and 4
    makes its role user. Nulls are one space."""
    blank = F.lit(" ")

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), blank)

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text, role = text_of("text"), text_of("role")
    return conversations.select("conv_id", "turn", "role", "text", kind.alias("kind")).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind").isin(0, 1), "")
        .when(F.col("kind") == 2, F.translate(text, ENDS, ""))
        .otherwise(text)
        .alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )
