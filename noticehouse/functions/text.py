"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize(text: Column) -> Column:
    """Strip spaces, lower the case; blank text becomes null."""
    return F.nullif(F.lower(F.trim(text)), F.lit(""))


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
