"""Alignment of two tokenizers over a corpus, with counts of linked token ids.

Two token sequences of the same bytes are cut into groups where both end. Tokens
whose byte ranges overlap are linked, and an id pair counts the documents that hold
it linked. Counting is an external sort in the tables of Spark:

1. A task turns documents into (pair, document, times) records. Each run of about a
   million words is sorted with the first tokenizer's id in front, cut by a radix of
   that id and compressed with zstandard: one row per run and radix part.
2. The runs of a part are merged through a heap, at most about ``FAN`` at once, level
   by level until one is left. A merge reads of a run only its pairs and how many of
   its documents hold each, so a pair of all documents is one number per run. The
   last merge passes a first id's pairs in a row, so it knows their maximum.
3. The totals of a part go through its runs once more, and each record adds its
   share to its document.

Text between runs of white space is never joined by either vocabulary, so each such
word is encoded and aligned once and kept while there is room. A text with a
character that breaks this is encoded as a whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.llm.common import kept, stage, text_bytes
from noticehouse.llm.tokens import slices

RUN_WORDS = 1 << 20
FAN = 64
#: Radix parts of a run, by the low bits of the first id.
PART_BITS = 4
#: Bits of an id and of a document's number in its run.
ID_BITS, DOC_BITS = 18, 22
CACHED_WORDS, CACHED_CHARS, WORDS_AT_ONCE = 250_000, 8 << 20, 20_000

#: Words of plain texts begin at a run of these; other texts are one word.
WORDS = re.compile(r"[ \t\n]+[^ \t\n]*")
#: Code points at which a word may not be cut out of a text: controls, white space
#: other than those, and the mark that stands for a space.
_APART = [(0, 8), (11, 31), (127, 160), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F), (0x2028, 0x202F),
          (0x205F, 0x2064), (0x2581, 0x2581), (0x3000, 0x3000), (0xFEFF, 0xFEFF)]
PLAIN = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _APART) + "]*")

#: Characters on which word patterns of all engines agree.
LATIN = re.compile("[ \t\n!-~\u00a1-\u024f]*")
#: Fixed value: the pattern by which byte-level vocabularies of this kind split text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

RECORDS = (
    "run bigint, local int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " groups_sha256 string, groups string,"
    " part int, pairs binary, holders binary, docs binary, times binary"
)
MERGED = "part int, run bigint, pairs binary, holders binary"
TOTALS = "part int, pairs binary, totals binary, best binary"
SHARES = "run bigint, local int, n_best bigint, count_sum bigint"


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    octets = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.compress(octets.T.tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    octets = raw.reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(octets.T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)).astype("<u8"))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def byte_level(token: str) -> bytes:
    """The bytes that a byte-level vocabulary writes as printable characters."""
    return bytes(_BYTE_OF[c] for c in token)


def _byte_table() -> dict[str, int]:
    """Printable bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


_BYTE_OF = _byte_table()


class Aligner:
    """Words to their place in flat tables: counts, group texts and linked pairs.

    Words are learnt many at once: put one after another they are one stretch of
    bytes, and where tokens of either kind end in it gives all links and groups.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        special = {i: t.content.encode() for i, t in self._a.get_added_tokens_decoder().items()}
        tokens = [self._a.id_to_token(k) for k in range(self._a.get_vocab_size())]
        self._a_bytes = [special[k] if k in special else byte_level(t) for k, t in enumerate(tokens)]
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self._b.id_to_piece(k) for k in range(self._b.get_piece_size())]
        self._b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in enumerate(pieces)
        ]
        if max(len(tokens), len(pieces)) > 1 << ID_BITS:
            raise ValueError(f"ids of more than {ID_BITS} bits")
        self._a_sizes, self._b_sizes = (
            np.fromiter(map(len, table), np.int64, len(table)) for table in (self._a_bytes, self._b_bytes)
        )
        # Else words could be joined across the cut.
        self._cuts = self._b.encode("a b", out_type=str)[:1] == ["▁a"] and not any(
            "▁" in p.lstrip("▁") or "\n" in p or "\t" in p for p in pieces
        )
        self._quick = self._by_rank(a_path, special)
        self.clear()

    def _by_rank(self, path: str, special: dict[int, bytes]):
        """The same merges as a rank encoder, several times as fast, if ids go by rank."""
        with open(path) as file:
            made = json.load(file)
        ids, merges = made["model"]["vocab"], made["model"]["merges"]
        joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        in_order = all(ids[m] == 256 + k for k, m in enumerate(joined))
        if not in_order or made["pre_tokenizer"] != plain or made["normalizer"] is not None:
            return None
        import tiktoken

        ranks = {b: k for k, b in enumerate(self._a_bytes) if k not in special}
        return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def full(self) -> bool:
        return len(self.places) > CACHED_WORDS or self._chars > CACHED_CHARS

    def clear(self) -> None:
        self._chars = 0
        self.places: dict[str, int] = {}
        #: Group texts by place; none for a word that its tokens do not spell.
        self.groups: list[str | None] = []
        self._counts = [np.zeros((0, 3), np.int64)]
        self._sizes, self._pairs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]

    def words(self, text: str) -> list[str]:
        """A space and the text, cut where neither vocabulary joins."""
        spaced = " " + text
        return WORDS.findall(spaced) if self.plain(text) else [spaced]

    def plain(self, text: str) -> bool:
        return self._cuts and PLAIN.fullmatch(text) is not None

    def learn(self, words: list[str]) -> None:
        """Words that :meth:`words` cut out of plain texts."""
        quick, slow = [], []
        for word in words:
            (quick if self._quick and LATIN.fullmatch(word) and word[-1] not in " \t\n" else slow).append(word)
        for group in (quick, slow):
            for at in range(0, len(group), WORDS_AT_ONCE):
                part = group[at : at + WORDS_AT_ONCE]
                # The second vocabulary puts a space in front; a letter keeps words from it.
                b_ids = [ids[1:] for ids in self._b.encode(["a" + w for w in part], num_threads=1)]
                a_ids = self._joined(part) if group is quick else self._each(part)
                self._store(part, *a_ids, b_ids)

    def learn_text(self, spaced: str) -> None:
        """A space and a text that cannot be cut."""
        self._store([spaced], *self._each([spaced]), [self._b.encode(spaced[1:])])

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self._a.encode_batch_fast(words, add_special_tokens=False)]
        return _flat(found), np.fromiter(map(len, found), np.int64, len(found))

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words begin with white space and end without, so they are never merged."""
        flat = np.array(self._quick.encode_ordinary("".join(words)), np.int64)
        ends = np.cumsum(self._a_sizes[flat])
        of_words = np.cumsum([len(w.encode()) for w in words])
        return flat, np.diff(np.searchsorted(ends, of_words), prepend=-1)

    def _store(self, words: list[str], a: np.ndarray, a_counts: np.ndarray, b_ids: list[list[int]]) -> None:
        raws = [w.encode() for w in words]
        b = _flat(b_ids)
        b_counts = np.fromiter(map(len, b_ids), np.int64, len(b_ids))
        spelt = _spelt(raws, a, a_counts, self._a_bytes) & _spelt(raws, b, b_counts, self._b_bytes)
        a, b = a[np.repeat(spelt, a_counts)], b[np.repeat(spelt, b_counts)]
        a_ends, b_ends = np.cumsum(self._a_sizes[a]), np.cumsum(self._b_sizes[b])
        sizes = np.where(spelt, np.fromiter(map(len, raws), np.int64, len(raws)), 0)
        of_words = np.cumsum(sizes)
        # Between two ends of either kind one token of each kind goes on: a link.
        ends = np.union1d(a_ends, b_ends)
        links = a[np.searchsorted(a_ends, ends)].astype(np.uint64) << np.uint64(ID_BITS)
        links |= b[np.searchsorted(b_ends, ends)].astype(np.uint64)
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        a_cuts = [0, *(np.searchsorted(a_ends, shared) + 1).tolist()]
        b_cuts = [0, *(np.searchsorted(b_ends, shared) + 1).tolist()]
        texts = [
            f"{','.join(a_text[i:j])}|{','.join(b_text[k:n])}"
            for i, j, k, n in zip(a_cuts, a_cuts[1:], b_cuts, b_cuts[1:])
        ]
        of_group = np.searchsorted(shared, of_words, side="right")
        of_link = np.searchsorted(ends, of_words, side="right")
        starts = [0, *of_group.tolist()]
        for word, good, i, j in zip(words, spelt.tolist(), starts, starts[1:]):
            self.places[word] = len(self.groups)
            self.groups.append(";".join(texts[i:j]) if good else None)
            self._chars += len(word)
        counts = np.column_stack([a_counts * spelt, b_counts * spelt, np.diff(of_group, prepend=0)])
        self._counts.append(counts)
        self._sizes.append(np.diff(of_link, prepend=0))
        self._pairs.append(links)

    def links(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words in a row: their linked pairs, how many each word has, and its
        numbers of tokens and groups."""
        self._counts, self._sizes, self._pairs = (
            [np.concatenate(x)] for x in (self._counts, self._sizes, self._pairs)
        )
        sizes = self._sizes[0]
        starts, each = (np.cumsum(sizes) - sizes)[places], sizes[places]
        ends = np.cumsum(each)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - each), each)
        return self._pairs[0][at], each, self._counts[0][places]


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _spelt(raws: list[bytes], ids: np.ndarray, counts: np.ndarray, table: list[bytes]) -> np.ndarray:
    """Which words the bytes of their tokens spell."""
    parts = [table[k] for k in ids.tolist()]
    cuts = [0, *np.cumsum(counts).tolist()]
    return np.array([b"".join(parts[i:j]) == raw for raw, i, j in zip(raws, cuts, cuts[1:])], bool)


def _text(body: bytes) -> str:
    """What is not UTF-8 counts as no text."""
    try:
        return bytes(body).decode()
    except UnicodeDecodeError:
        return ""


def aligner(a_path: str, b_path: str) -> Aligner:
    return kept(("cross-tokens", a_path, b_path), lambda: Aligner(a_path, b_path))


def sorted_parts(pairs: np.ndarray, docs: np.ndarray, bits: int) -> Iterator[tuple]:
    """A run's records: for each radix part its sorted pairs, how many documents hold
    each, and these documents with their numbers of links."""
    order = np.sort(pairs << np.uint64(DOC_BITS) | docs.astype(np.uint64))
    first = np.flatnonzero(np.diff(order, prepend=~order[:1]) != 0)
    times = np.diff(first, append=len(order))
    records = order[first]
    of_pair, doc = records >> np.uint64(DOC_BITS), records & np.uint64((1 << DOC_BITS) - 1)
    part_of = (of_pair >> np.uint64(ID_BITS)) & np.uint64((1 << bits) - 1)
    for part in np.unique(part_of).tolist():
        mine = part_of == part
        own = of_pair[mine]
        starts = np.flatnonzero(np.diff(own, prepend=~own[:1]) != 0)
        yield part, own[starts], np.diff(starts, append=len(own)), doc[mine], times[mine]


def heap_merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Sorted pairs with the sums of their numbers over all runs."""
    streams = [zip(pairs.tolist(), numbers.tolist()) for pairs, numbers in runs]
    now, total = -1, 0
    for pair, number in heapq.merge(*streams):
        if pair != now:
            if now >= 0:
                yield now, total
            now, total = pair, 0
        total += number
    if now >= 0:
        yield now, total


def _runs(pdf: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(unpack_sorted(p), unpack(h, "<u8")) for p, h in zip(pdf["pairs"], pdf["holders"])]


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Several runs of a part to one."""
    merged = list(heap_merge(_runs(pdf)))
    pairs, holders = (np.array(c, np.uint64) for c in zip(*merged))
    row = (pdf["part"].iloc[0], pdf["group"].iloc[0], pack_sorted(pairs), pack(holders))
    return pd.DataFrame([row], columns=["part", "run", "pairs", "holders"])


def _total(pdf: pd.DataFrame) -> pd.DataFrame:
    """The last merge of a part: totals, and which are the highest of their first id."""
    pairs, totals, best = [], [], []
    side, held, most = -1, 0, 0

    def close() -> None:
        best.extend(t == most for t in totals[len(totals) - held :])

    for pair, total in heap_merge(_runs(pdf)):
        if pair >> ID_BITS != side:
            close()
            side, held, most = pair >> ID_BITS, 0, 0
        pairs.append(pair)
        totals.append(total)
        held, most = held + 1, max(most, total)
    close()
    row = (
        pdf["part"].iloc[0],
        pack_sorted(np.array(pairs, np.uint64)),
        pack(np.array(totals, "<u8")),
        pack(np.array(best, np.uint8)),
    )
    return pd.DataFrame([row], columns=["part", "pairs", "totals", "best"])


def _share(runs: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    """What a part's totals add to the documents of its runs, run by run."""
    made = []
    if len(totals):
        every, counts, best = (
            unpack_sorted(totals["pairs"].iloc[0]),
            unpack(totals["totals"].iloc[0], "<u8").astype(np.int64),
            unpack(totals["best"].iloc[0], np.uint8).astype(np.int64),
        )
        for row in runs.itertuples():
            holders = unpack(row.holders, "<u8").astype(np.int64)
            at = np.repeat(np.searchsorted(every, unpack_sorted(row.pairs)), holders)
            docs, times = unpack(row.docs, "<u4"), unpack(row.times, "<u4").astype(np.int64)
            known, back = np.unique(docs, return_inverse=True)
            sums, bests = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
            np.add.at(sums, back, times * counts[at])
            np.add.at(bests, back, times * best[at])
            made.append(
                pd.DataFrame({"run": row.run, "local": known.astype(np.int32), "n_best": bests, "count_sum": sums})
            )
    return pd.concat(made) if made else pd.DataFrame(columns=["run", "local", "n_best", "count_sum"])


def record_runs(
    docs: DataFrame, a_path: str, b_path: str, run_words: int, bits: int, groups: bool
) -> DataFrame:
    """A row per document with its own figures, and a row per run and radix part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33
        aligned = aligner(a_path, b_path)
        names = [field.split()[0] for field in RECORDS.split(", ")]
        whole = [n for n in names if n.startswith("n_")] + ["local", "doc_id", "part"]
        rows: list[dict] = []
        places: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            nonlocal number
            made = list(rows)
            sizes = np.fromiter(map(len, places), np.int64, len(places))
            pairs, each, counts = aligned.links(np.concatenate(places))
            of_word = np.repeat(np.arange(len(sizes)), sizes)
            owners = np.repeat(of_word, each)
            n_links = np.bincount(owners, minlength=len(sizes)).tolist()
            sums = np.zeros((len(sizes), 3), np.int64)
            np.add.at(sums, of_word, counts)
            for row, n, (n_a, n_b, n_groups) in zip(made, n_links, sums.tolist()):
                row |= {"n_links": n, "n_a": n_a, "n_b": n_b, "n_groups": n_groups}
            for part, own, holders, held, times in sorted_parts(pairs, owners, bits) if len(pairs) else ():
                made.append(
                    {
                        "run": number, "part": part, "pairs": pack_sorted(own),
                        "holders": pack(holders.astype("<u8")), "docs": pack(held.astype("<u4")),
                        "times": pack(times.astype("<u4")),
                    }
                )
            number += 1
            rows.clear()
            places.clear()
            if aligned.full():
                aligned.clear()
            frame = pd.DataFrame(made, columns=names)
            return frame.astype({n: "Int64" for n in whole} | {"groups_sha256": object, "groups": object})

        words = 0
        for batch in batches:
            keys, bodies = batch["doc_id"].astype("Int64").tolist(), batch["body"].tolist()
            for a, b in slices(bodies, 1 << 20):
                texts = [_text(body) for body in bodies[a:b]]
                cut = [aligned.words(t) if t else [] for t in texts]
                known, new = aligned.places, {}
                for text, own in zip(texts, cut):
                    if text and not aligned.plain(text):
                        if own[0] not in known:
                            aligned.learn_text(own[0])
                    else:
                        new |= dict.fromkeys(own)
                aligned.learn([w for w in new if w not in known])
                for key, own in zip(keys[a:b], cut):
                    at = [known[w] for w in own]
                    parts = [aligned.groups[k] for k in at]
                    spelt = bool(parts) and None not in parts
                    joined = ";".join(parts) if spelt else ""
                    rows.append(
                        {
                            "run": number, "local": len(rows), "doc_id": key,
                            "groups_sha256": hashlib.sha256(joined.encode()).hexdigest() if spelt else "",
                            "groups": joined if groups else None,
                        }
                    )
                    places.append(np.array(at if spelt else [], np.int64))
                    # A text that is not cut is one word: what counts is what it holds.
                    words += max(len(at), len(joined) // 16)
                # Between slices, as words learnt may be forgotten with a run.
                if words >= run_words or len(rows) >= 1 << (DOC_BITS - 1):
                    yield flush()
                    words = 0
        if rows:
            yield flush()

    bodies = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("body")
    )
    return bodies.mapInPandas(run, RECORDS)


def count_pairs(runs: DataFrame, fan: int = FAN) -> DataFrame:
    """Totals of all pairs, a row per radix part."""
    runs = runs.select("part", "run", "pairs", "holders")
    number = runs.agg(F.count_distinct("run")).head()[0]
    while number > fan:
        number = -(-number // fan)
        group = F.pmod(F.xxhash64("run"), F.lit(number)).alias("group")
        runs = stage(
            runs.select("part", group, "pairs", "holders").groupBy("part", "group").applyInPandas(_merge, MERGED),
            "merged-runs",
        )
    return stage(runs.groupBy("part").applyInPandas(_total, TOTALS), "pair-totals")


def align_documents(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    *,
    run_words: int = RUN_WORDS,
    fan: int = FAN,
    part_bits: int = PART_BITS,
    groups: bool = False,
) -> DataFrame:
    """Per document ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256`` and, if asked for, the ``groups`` as text.

    ``a_path`` is a byte-level vocabulary of the tokenizers library, ``b_path`` a
    sentencepiece model that puts a space in front. Null and empty texts, texts that
    are not UTF-8 and those whose tokens do not spell them have no tokens. Each row is
    a document of its own, whatever its id; equal rows count as often as they are. An
    empty table gives no row. Other columns are not read.
    """
    records = stage(record_runs(docs, a_path, b_path, run_words, part_bits, groups), "pair-records")
    runs = records.where("part is not null").select("run", "part", "pairs", "holders", "docs", "times")
    totals = count_pairs(runs, fan)
    number = runs.agg(F.count_distinct("run")).head()[0]
    group = F.pmod(F.xxhash64("run"), F.lit(max(1, -(-number // fan)))).alias("group")
    grouped = runs.select("*", group)
    # A part's totals go once to each group of its runs.
    keys = grouped.select(F.col("part").alias("of_part"), F.col("group").alias("of_group")).distinct()
    sent = totals.join(keys, totals["part"] == F.col("of_part"))
    shares = (
        grouped.groupBy("part", "group").cogroup(sent.groupBy("of_part", "of_group")).applyInPandas(_share, SHARES)
    )
    summed = shares.groupBy("run", "local").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if groups else [])]
    documents = records.where("part is null").select("run", "local", *own)
    zero = F.lit(0).cast("bigint")
    return documents.join(summed, ["run", "local"], "left").select(
        *own, *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum"))
    )
