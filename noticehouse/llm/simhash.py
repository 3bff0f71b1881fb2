"""SimHash near-duplicates by covering locality-sensitive hashing.

A radius r has 2^(r+1) - 1 bit masks. Bit i gets a non-zero vector m(i) of r+1
bits, and the mask of a non-zero vector v keeps the bits i with an odd m(i).v.
For any r bits some v is even with all of them, so two fingerprints that differ
in r bits or fewer agree on that mask and meet in its table: no pair is missed.

Tables are read without comparing pairs. Fingerprints alone in their bucket of
every table have no partner. Those that share one are spread over the
fingerprints reached by flipping up to r/2 of the bits the mask leaves open: for
radius 2, all that meet at such a point are within the radius of each other, so
each is linked to the smallest only. Copies have one fingerprint and are one row
throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticehouse.llm.common import kept, stage, text_bytes
from noticehouse.llm.components import components

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2
#: Hashes expanded to single bits at once.
HASHES_AT_ONCE = 1 << 16


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of a text's word shingles, repeats included.

    ASCII letters are lower-cased; words end at ASCII white space. Fewer words
    than a shingle are one shingle; no words are none.
    """
    words = text.lower().split()
    if len(words) <= shingle:
        grams = [b" ".join(words)] if words else []
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hash64 = xxhash.xxh64_intdigest
    return np.fromiter((hash64(g, SEED) for g in grams), "<u8")


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes; 0 without any."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        octets = hashes[at : at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles; 0 without words."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The other columns, of numbers, and the fingerprint ``fp`` (signed 64-bit) of the
    whole ``text``; a null text is empty."""
    others = [c for c in texts.columns if c != "text"]

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept("simhash", dict)  # no model of an earlier stage is needed
        for batch in batches:
            made = batch[others].astype("Int64")
            yield made.assign(fp=[signed(fingerprint(t, shingle)) for t in batch["body"]])

    numbers = [F.col(c).cast("bigint").alias(c) for c in others]
    fields = ", ".join(f"{c} bigint" for c in [*others, "fp"])
    return texts.select(*numbers, text_bytes().alias("body")).mapInPandas(compute, fields)


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks such that any two values within the radius agree under one of them."""
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(bits) if ((i % vectors + 1) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def links_within_two(values: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect any two distinct values of ``fp`` that
    differ in 1 or 2 bits, directly or through values that do.

    A meeting point gathers at most as many values as the mask leaves bits open.
    """
    masks = covering_masks(2)
    # At the point itself or one open bit from it.
    flips = [[0, *(1 << i for i in range(BITS) if not m >> i & 1)] for m in masks]
    tables = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(k).alias("mask"),
                    F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"),
                )
                for k, m in enumerate(masks)
            )
        )
    )
    rows = values.select("fp", tables.alias("t")).select("fp", "t.mask", "t.key")
    met = (
        rows.groupBy("mask", "key")
        .agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
        .where("least < most")
        .select("mask", "key")
    )
    open_bits = F.array(
        *(F.array(*(F.lit(signed(x)) for x in each)) for each in flips)
    )
    points = (
        rows.join(met, ["mask", "key"])
        .select("mask", "fp", F.explode(open_bits[F.col("mask")]).alias("flip"))
        .select("mask", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    )
    meetings = points.groupBy("mask", "point").agg(F.collect_list("fp").alias("fps"))
    return (
        meetings.where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .where("a < b")
    )


def _roots(marked: DataFrame, order: Column) -> DataFrame:
    """For each fingerprint ``fp`` the ``root`` of its component, and the ``first`` of
    its rows by an order."""
    rows = marked.count()
    classes = stage(marked.groupBy("fp").agg(F.min(order).alias("first")), "fingerprint-classes", rows)
    links = links_within_two(classes.select("fp"))
    members = stage(components(links, "a", "b"), "components", rows)
    found = classes.join(members.withColumnRenamed("node", "fp"), "fp", "left")
    return found.select("fp", F.coalesce("root", "fp").alias("root"), "first")


def _order(*columns: str) -> Column:
    """By document id, null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), *columns)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``: the smallest document id reachable
    over links between fingerprints that differ in 2 bits or fewer.

    Texts without words share fingerprint 0. Equal ids with different texts keep
    a row each. Null ids count as larger than any other; a component of nothing
    else has a null id. An empty table gives no row.
    """
    marked = stage(fingerprints(docs.select("doc_id", "text"), shingle), "fingerprints")
    roots = _roots(marked, _order())
    least = roots.groupBy("root").agg(F.min("first").alias("least"))
    found = roots.select("fp", "root").join(least, "root")
    of_class = found.select("fp", F.col("least.doc_id").alias("component_id"))
    return marked.join(of_class, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of :func:`near_duplicates`: that with the smallest id,
    null ids last, of equal ids any one.

    Rows are told apart by a key of their own, whatever their id: different texts of
    one id both stay, null ids are rows like any other, and of repeated rows one
    stays. Texts without words (null, empty) are one group. Columns may be of any
    type and name; an empty table gives no row.
    """
    key = "row_key"
    while key in map(str.lower, docs.columns):
        key += "_"
    keyed = stage(docs.withColumn(key, F.monotonically_increasing_id()), "keyed-documents")
    texts = keyed.select(F.col(key).alias("key"), "doc_id", "text")
    marked = stage(fingerprints(texts, shingle), "fingerprints")
    least = _roots(marked, _order("key")).groupBy("root").agg(F.min("first").alias("first"))
    stays = least.select(F.col("first.key").alias(key))
    # The list grows with the table, so it is never broadcast.
    return keyed.join(stays.hint("merge"), key, "left_semi").select(docs.columns)
