"""Main text of web pages by differencing pages with near URLs.

Pages are put in order of host and URL path. Each is paired with the nearest page
before it of its host that is no copy of it, or, at the start of a host, the first
such after it. Their text lines are aligned by a longest common subsequence; what
they share is the site's, not the page's, and is deleted. Text the markup itself
sets apart (scripts, menus, forms, comments and the like) goes in any case, and
blocks the markup calls an article stay, even where pages quote the same passage.

Pages whose lines are all the same are one entry of a narrow table: hashes and
lengths of lines. Entries are numbered in order without gaps, so that neighbours
meet by number, a hot host is spread evenly, and pairs do not depend on where
partitions begin. A run of near copies is a group: it begins where an entry is no
copy of the one before, and pairs with the last entry of the group before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticehouse.llm.common import kept, stage
from noticehouse.llm.html_lines import APART, DOUBT, MAIN, OTHER, lines_of
from noticehouse.operators.numbering import numbered

#: Pages that share this much of their characters are copies.
COPY = 0.9
#: Entries whose groups are looked for together.
BLOCK = 1 << 14

#: Two hashes that stand for all lines of a page.
CLASS = ["host", "c1", "c2"]
KEYS = "page_id bigint, url string, host string, path string, c1 bigint, c2 bigint"


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` on a longest common subsequence with ``b``.

    Equal ends are matched first; the rest by bit rows, one bit per line of b.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(head), *range(len(a) - tail, len(a))}
    in_a = set(a[head : len(a) - tail])
    right = [x for x in b[head : len(b) - tail] if x in in_a]
    in_b = set(right)
    left = [k for k in range(head, len(a) - tail) if a[k] in in_b]
    places: dict[str, int] = {}
    for k, text in enumerate(right):
        places[text] = places.get(text, 0) | 1 << k
    full = (1 << len(right)) - 1
    rows = [full]
    for k in left:
        v, m = rows[-1], places[a[k]]
        rows.append(((v + (v & m)) | (v & ~m)) & full)
    # A zero bit of a row is a line of b that lengthens the subsequence.
    at = len(right) - 1
    for n in range(len(left), 0, -1):
        while at >= 0 and rows[n] >> at & 1:
            at -= 1
        if at < 0:
            break
        if rows[n - 1] >> at & 1:
            found.add(left[n - 1])
            at -= 1
    return found


def is_copy(own: list[int], lengths: list[int], kinds: list[int], other: list[int]) -> bool:
    """Whether nearly all of a page's text is the other's too."""
    shared = shared_lines(own, other)
    places = [k for k, kind in enumerate(kinds) if kind != APART]
    size = sum(lengths[k] for k in places)
    return bool(size) and sum(lengths[k] for k in places if k in shared) >= COPY * size


def _hash(text: str) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))).astype(np.int64))


def _parse(texts: bool):
    """Pages to lines: their texts, or hashes and lengths of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept("pages", dict)  # no model of an earlier stage is needed
        for batch in batches:
            rows, size = [], 0
            for page_id, url, host, path, source in zip(
                batch["page_id"].astype("Int64"), batch["url"], batch["host"], batch["path"], batch["html"]
            ):
                lines = lines_of(source)
                kinds = [k for _, k in lines]
                hashes = [_hash(t) for t, _ in lines]
                own = repr((hashes, kinds))
                body = [t for t, _ in lines] if texts else [len(t) for t, _ in lines]
                row = (page_id, url, host, path, _hash(own), _hash(own + "2"), kinds, body)
                rows.append(row if texts else (*row, hashes))
                size += len(source)
                if size >= 8 << 20:
                    yield _frame(rows)
                    rows, size = [], 0
            if rows:
                yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["page_id", "url", "host", "path", "c1", "c2", "kinds", "body", "hashes"][: len(rows[0])]
    made = pd.DataFrame(rows, columns=names)
    return made.astype({"page_id": "Int64", "url": object, "host": object, "path": object})


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whether each entry begins a group, beside the entry before it."""
    for batch in batches:
        begins = [
            before is None
            or not is_copy(own.tolist(), lengths.tolist(), kinds.tolist(), before.tolist())
            for own, lengths, kinds, before in zip(
                batch["hashes"], batch["body"], batch["kinds"], batch["before"]
            )
        ]
        yield pd.DataFrame({"id": batch["id"], "begins": begins, "alone": batch["before"].isna()})


def _stays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Places of the lines that stay, beside the entry's partner."""
    for batch in batches:
        places = []
        for own, kinds, other in zip(batch["hashes"], batch["kinds"], batch["other"]):
            shared = shared_lines(own.tolist(), other.tolist()) if other is not None else set()
            places.append(
                [
                    k
                    for k, kind in enumerate(kinds.tolist())
                    if kind == MAIN or kind in (OTHER, DOUBT) and k not in shared
                ]
            )
        yield batch[CLASS].assign(places=places)


def _write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [
            "\n".join(lines[k] for k in places.tolist()) for lines, places in zip(batch["body"], batch["places"])
        ]
        made = pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})
        made.insert(0, "url", batch["url"].to_numpy())
        made.insert(0, "page_id", batch["page_id"].astype("Int64").to_numpy())
        yield made.astype({"page_id": "Int64", "url": object})


def _partners(begun: DataFrame) -> DataFrame:
    """``id`` and ``partner``: the last entry of the group before, or the first one of
    the group after, in the same host; null without one.

    Blocks of numbers carry the last group begun before them and the first one begun
    after them, a row per block.
    """
    block = F.floor(F.col("id") / BLOCK).alias("block")
    start = F.when(F.col("begins"), F.struct("id", "alone"))
    marked = begun.select("id", block, start.alias("start"))
    blocks = marked.groupBy("block").agg(F.max("start").alias("last"), F.min("start").alias("first"))
    # What follows is read backwards: a frame that only grows is summed up row by row.
    so_far, strictly = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)
    upward, downward = Window.orderBy("block"), Window.orderBy(F.desc("block"))
    carried = blocks.select(
        "block",
        F.max("last").over(upward.rowsBetween(*strictly)).alias("carried"),
        F.min("first").over(downward.rowsBetween(*strictly)).alias("coming"),
    )
    within = Window.partitionBy("block")
    upward, downward = within.orderBy("id"), within.orderBy(F.desc("id"))
    found = marked.join(carried, "block").select(
        "id",
        F.coalesce(F.max("start").over(upward.rowsBetween(*so_far)), "carried").alias("own"),
        F.coalesce(F.min("start").over(downward.rowsBetween(*strictly)), "coming").alias("next"),
    )
    after = F.when(~F.col("next.alone"), F.col("next.id"))
    partner = F.when(F.col("own.alone"), after).otherwise(F.col("own.id") - 1)
    return found.select("id", partner.alias("partner"))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` (blocks joined by a newline) and ``n_chars``.

    A null page is empty; a null URL is the host without a name; repeated rows
    are copies. A page without a partner in its host loses only what its markup sets
    apart. An empty table gives no row. Other columns are not read.
    """
    url = F.coalesce("url", F.lit(""))
    source = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:[^/?#]*:)?(?://[^/?#]*)?([^?#]*)", 1).alias("path"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    narrow = source.mapInPandas(
        _parse(False), f"{KEYS}, kinds array<int>, body array<bigint>, hashes array<bigint>"
    )
    first = F.min(F.struct("path", F.col("page_id").isNull().alias("no_id"), "page_id")).alias("first")
    same = [F.any_value(c).alias(c) for c in ("kinds", "body", "hashes")]
    classes = narrow.groupBy(*CLASS).agg(first, *same).select("*", "first.path", "first.no_id", "first.page_id")
    order: list[Column | str] = ["host", "path", "no_id", "page_id", "c1", "c2"]
    entries = numbered(classes.drop("first"), order)
    before = entries.select((F.col("id") + 1).alias("id"), F.col("host").alias("of"), F.col("hashes").alias("before"))
    neighbour = F.when(F.col("of") == F.col("host"), F.col("before")).alias("before")
    begun = (
        entries.join(before, "id", "left")
        .select("id", "kinds", "body", "hashes", neighbour)
        .mapInPandas(_compare, "id bigint, begins boolean, alone boolean")
    )
    partners = _partners(stage(begun, "page-groups"))
    others = entries.select(F.col("id").alias("partner"), F.col("hashes").alias("other"))
    met = entries.join(partners, "id").join(others, "partner", "left")
    stays = met.select(*CLASS, "kinds", "hashes", "other").mapInPandas(
        _stays, "host string, c1 bigint, c2 bigint, places array<int>"
    )
    stays = stage(stays, "page-lines")
    lines = source.mapInPandas(_parse(True), f"{KEYS}, kinds array<int>, body array<string>")
    return (
        lines.select("page_id", "url", *CLASS, "body")
        .join(stays, CLASS)
        .select("page_id", "url", "body", "places")
        .mapInPandas(_write, "page_id bigint, url string, text string, n_chars bigint")
    )
