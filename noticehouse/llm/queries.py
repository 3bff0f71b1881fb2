"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticehouse.llm import (
    ann,
    bitplanes,
    conversations,
    cross_tokens,
    decontaminate,
    html_text,
    langid,
    line_dedup,
    lm_score,
    packing,
    quality,
    simhash,
    toxicity,
)
from noticehouse.llm.common import ship_package, table, tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    @wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return shipped


@query
def op5_page_differencing(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query
def op6_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op10_bit_planes(spark, sf_dir):
    read = bitplanes.token_files(table(spark, sf_dir, "documents"), tokenizer_file())
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_language(spark, sf_dir):
    return langid.identify_languages(table(spark, sf_dir, "documents"))


@query
def op3_stupid_backoff(spark, sf_dir):
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


@query
def op4_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op7_prefix_forest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op8_string_tiling(spark, sf_dir):
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op9_quality_rules(spark, sf_dir):
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_conversation_repair(spark, sf_dir):
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(damaged)


@query
def op11_cross_tokens(spark, sf_dir):
    return cross_tokens.align_documents(
        table(spark, sf_dir, "documents"),
        tokenizer_file("byte_bpe_50k.json"),
        tokenizer_file("piece_bpe_32k.model"),
    )
