"""A bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.llm.common import split_of, text_bytes

#: Labelled documents a model is fitted on at most, taken by a hash of the id.
SAMPLE_ROWS = 20_000


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, most: int = SAMPLE_ROWS
) -> DataFrame:
    """``doc_id``, ``body`` (UTF-8) and ``label`` 0/1 of a sample of the documents
    that are not held out.

    Rows without an id, a label or a document do not count; several labels of a
    document are averaged, several rows of it count once, the smallest text. The
    broadcast side has ``most`` rows of two numbers.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .where(split_of("doc_id", parts) != held_out)
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    bodies = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("body")
    )
    return (
        bodies.join(F.broadcast(known), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("body").alias("body"))
    )
