"""Record keys and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticehouse.functions.text import non_empty

# How the dimension keys are spelled before hashing.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"
UNKNOWN_PREFIX = "unknown_"
UNKNOWN_LABEL = "Unknown"
MISSING_KEY_PREFIX = "missing_key_"


def first_present(*columns: Column) -> Column:
    """Silver key: the first identifier that is not null."""
    return F.coalesce(*(c.cast("string") for c in columns))


def first_truthy(texts: list[Column], number: Column, position: Column) -> Column:
    """Producer key: as above, but empty text and zero do not count either, and
    a record without any identifier gets a key of its own."""
    return F.coalesce(
        *(non_empty(t) for t in texts),
        F.nullif(number, F.lit(0)).cast("string"),
        F.concat(F.lit(MISSING_KEY_PREFIX), position.cast("string")),
    )


def surrogate_key(*columns: Column) -> Column:
    parts = (F.coalesce(c.cast("string"), F.lit(NULL_MARKER)) for c in columns)
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def unknown_key(dimension: str) -> Column:
    """Key of a dimension's unknown member."""
    return F.md5(F.lit(UNKNOWN_PREFIX + dimension.removeprefix("dim_")))
