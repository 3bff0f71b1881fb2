"""From message text to typed silver columns. Narrow work only: no shuffle.

``keep`` names message columns (a batch number, an arrival position) that ride
along untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.functions.dates import as_date, as_timestamp
from noticehouse.functions.keys import first_present, first_truthy
from noticehouse.functions.payload import array_to_json, message_text, parse_payload
from noticehouse.functions.text import normalize
from noticehouse.spec import FeedSpec

RAW = "raw_json"


def parse_messages(
    messages: DataFrame, spec: FeedSpec, keep: Sequence[str] = ()
) -> DataFrame:
    """Parse each message; drop those without a usable id, keep the raw text.

    The one-element ``inline`` keeps the id filter above the parser. As a plain
    projection it would be pushed below, and every message be parsed twice.
    """
    text = messages.select(message_text(F.col("value")).alias(RAW), *keep)
    parsed = F.array(parse_payload(F.col(RAW), spec.schema))
    return text.select("*", F.inline(parsed)).where(F.col(spec.id_field).isNotNull())


def normalize_text(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return df.withColumns({c: normalize(F.col(c)) for c in spec.text_fields})


def cast_dates(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Typed times and dates; fields that have a silver name of their own get it."""
    typed = df.withColumns(
        {c: as_timestamp(F.col(c)) for c in spec.timestamp_fields}
        | {c: as_date(F.col(c)) for c in spec.date_fields}
    )
    return typed.withColumnsRenamed(
        {c: spec.silver_name(c) for c in spec.date_fields}
    )


def arrays_to_json(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return df.withColumns({c: array_to_json(F.col(c)) for c in spec.array_fields})


def clean_messages(
    messages: DataFrame, spec: FeedSpec, keep: Sequence[str] = ()
) -> DataFrame:
    return (
        parse_messages(messages, spec, keep)
        .transform(normalize_text, spec)
        .transform(cast_dates, spec)
        .transform(arrays_to_json, spec)
    )


def to_silver_columns(
    cleaned: DataFrame, spec: FeedSpec, keep: Sequence[str] = ()
) -> DataFrame:
    """The silver write set; the ingest stamp lives on in the payload only."""
    return cleaned.withColumnsRenamed(
        {spec.id_field: spec.api_id, RAW: spec.payload}
    ).select(*spec.silver_columns, *keep)


def with_dedup_key(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Add the silver key; rows that have none cannot be merged and go."""
    key = first_present(*map(F.col, (*spec.key_fields, spec.api_id)))
    return df.withColumn(spec.key, key).where(F.col(spec.key).isNotNull())


def silver_rows(
    messages: DataFrame, spec: FeedSpec, keep: Sequence[str] = ()
) -> DataFrame:
    """Everything from message to keyed, typed row."""
    return (
        clean_messages(messages, spec, keep)
        .transform(to_silver_columns, spec, keep)
        .transform(with_dedup_key, spec)
    )


def with_producer_key(
    records: DataFrame, spec: FeedSpec, position: str, name: str = "producer_key"
) -> DataFrame:
    texts = [F.col(c) for c in spec.key_fields]
    return records.withColumn(
        name, first_truthy(texts, F.col(spec.id_field), F.col(position))
    )
