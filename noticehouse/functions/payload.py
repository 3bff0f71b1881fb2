"""JSON payloads and content comparison."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMPTY_OBJECT = "{}"


def message_text(value: Column) -> Column:
    return value.cast("string")


def parse_payload(text: Column, schema: T.StructType) -> Column:
    """Struct of the declared schema; null fields where text does not fit."""
    return F.from_json(text, schema)


def array_to_json(array: Column) -> Column:
    return F.to_json(array)


def array_length(json_array: Column) -> Column:
    return F.coalesce(F.json_array_length(json_array), F.lit(0))


def differs(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """Null-safe "any of these columns differs"."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


def content_digest(columns: Iterable[str]) -> Column:
    """SHA-256 of the named columns, as 32 bytes.

    Two rows agree on all columns (null equal to null) exactly when the digests
    agree, so a merge can compare content by reading one narrow column. JSON
    text keeps values apart: strings are quoted and nulls are left out.
    """
    fields = ", ".join(f"cast(`{c}` as string) as `{c}`" for c in columns)
    return F.expr(f"unhex(sha2(to_json(struct({fields})), 256))")
