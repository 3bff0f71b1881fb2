"""Lines that several documents share, dropped from all but the first of them.

Lines are exploded with their positions and normalised: ASCII white space off both
ends, ASCII letters lower-cased. Each is hashed to 128 bits, distinct documents are
counted per hash, and a line held by enough documents goes from every document but
the one with the smallest id. Only hashes and positions move until then; a text
meets the positions it loses once, and is put together again from the others.

Counting first makes (hash, document) distinct and then counts per hash, both with
a partial aggregation before the shuffle, so a line of a third of all documents is
one row per task. The join of lines with repeated hashes is an equi-join of one
row per hash, whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticehouse.llm.common import stage

LEAST_DOCUMENTS = 2
LEAST_LENGTH = 10
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEPT = "doc_id bigint, n_lines bigint, n_dropped bigint, text string"


def _bodies(docs: DataFrame) -> DataFrame:
    """``state`` tells rows of one id apart by their text; equal rows lose the same."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(body).alias("state"),
        body.alias("body"),
    )


def _lines(bodies: DataFrame, least_length: int) -> DataFrame:
    """Place and hash of every line long enough to count."""
    lowered = F.translate("body", UPPER, LOWER)
    key = F.btrim("line", F.lit(SPACE))
    return (
        bodies.select("doc_id", "state", F.posexplode(F.split(lowered, "\n", -1)).alias("pos", "line"))
        .select("doc_id", "state", "pos", key.alias("key"))
        .where(F.char_length("key") >= least_length)
        .select("doc_id", "state", "pos", *_hash(F.col("key")))
    )


def _hash(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")


def repeated_lines(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_length: int = LEAST_LENGTH
) -> DataFrame:
    """Hashes ``h1``, ``h2`` of the lines that enough documents hold, the number of
    these documents, and the smallest id, ``first``."""
    holders = _lines(_bodies(docs), least_length).select("h1", "h2", "doc_id").distinct()
    counted = holders.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_documents"), F.min("doc_id").alias("first")
    )
    return counted.where(F.col("n_documents") >= least_documents)


def _reassemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, counts, dropped = [], [], []
        for body, places in zip(batch["body"], batch["dropped"]):
            lines = body.split("\n")
            counts.append(len(lines))
            lost = () if places is None else set(places.tolist())
            dropped.append(len(lost))
            texts.append("\n".join(s for k, s in enumerate(lines) if k not in lost) if lost else body)
        made = pd.DataFrame({"n_lines": counts, "n_dropped": dropped, "text": texts})
        made.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
        yield made.astype({"doc_id": "Int64"})


def drop_repeated_lines(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_length: int = LEAST_LENGTH
) -> DataFrame:
    """``doc_id``, ``n_lines`` (before), ``n_dropped`` and the ``text`` that is left.

    A key of ``least_length`` code points or more held by ``least_documents`` or
    more documents stays, with all its lines, in the one with the smallest id only.
    Rows of one id are one document; a null id is one too, larger than any other.
    A null or empty text is one empty line; a text that loses all lines is empty.
    Repeated rows stay as often as they are. An empty table gives no row. Columns
    other than ``doc_id`` and ``text`` are not read.
    """
    bodies = _bodies(docs)
    repeated = stage(
        repeated_lines(docs, least_documents, least_length).select("h1", "h2", "first"),
        "repeated-lines",
    )
    lost = (
        _lines(bodies, least_length)
        .join(repeated, ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("first")))
        # Of one text, so no longer than its list of lines.
        .groupBy("doc_id", "state")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    same = F.col("b.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("b.state") == F.col("l.state"))
    met = bodies.alias("b").join(lost.alias("l"), same, "left")
    return met.select("b.doc_id", "b.body", "l.dropped").mapInPandas(_reassemble, KEPT)
