"""The training-data pipeline over ``documents``.

Each stage works on all that the one before it kept, as a written table. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticehouse.llm import decontaminate, langid, packing, quality, simhash
from noticehouse.llm.common import ship_package, stage, table, tokenizer_file

LEAST_QUALITY = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores as good: null and empty texts by the
    score of an empty one. Rows are judged one by one, whatever their id."""
    ship_package(spark)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.with_quality(docs, model, "__quality")
    return scored.where(scored["__quality"] >= LEAST_QUALITY).drop("__quality")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; null and empty texts, and those without a letter,
    go."""
    ship_package(spark)
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates by SimHash, that with the smallest id;
    null ids come last, texts without words are one group, and different texts of one
    id are different documents."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; null, empty and short texts stay."""
    ship_package(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece of a document. A null or empty text is its
    end id alone; repeated rows are documents of their own."""
    ship_package(spark)
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality", keep_quality),
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Fitted models, automata and tokenizers are not SQL; tests/llm holds brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again. An empty table, or
    one of which nothing is kept, gives no piece."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
