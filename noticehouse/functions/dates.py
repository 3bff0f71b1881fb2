"""Dates and times given as text, and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO 8601 date-times, in the extended and the basic form. A day may
# stand alone; a time may lack seconds or minutes; a zone is an offset or Z. Groups:
# year, -, month, day, hour, colon, minute, second, fraction, zone.
ISO = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)


def as_timestamp(text: Column) -> Column:
    """Timestamp, or null for text that is none (also under ANSI mode)."""
    return F.try_to_timestamp(text)


def as_date(text: Column) -> Column:
    """Date as written, whatever zone follows it; null for text that is none."""
    return text.try_cast("date")


def parse_publication(text: Column) -> Column:
    """ISO date-time with or without zone, extended or basic; else the day in the
    first ten characters; else null.

    Only an offset is a zone: a zone's name falls back to the day.
    """

    def part(n: int, default: str = "") -> Column:
        found = F.regexp_extract(text, ISO, n)
        return F.when(found == "", default).otherwise(found) if default else found

    date = F.concat_ws("-", part(1), part(3), part(4))
    fraction = F.when(part(9) != "", F.concat(F.lit("."), F.substring(part(9), 1, 6)))
    clock = F.concat(
        F.concat_ws(":", part(5, "00"), part(7, "00"), part(8, "00")),
        F.coalesce(fraction, F.lit("")),
    )
    zone = F.regexp_replace(part(10), r"^([+-]\d{2}):?(\d{2})?$", "$1:$2")
    zone = F.when(zone.endswith(":"), F.concat(zone, F.lit("00"))).otherwise(zone)
    exact = F.try_to_timestamp(F.concat(date, F.lit("T"), clock, zone))
    day = F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-M-d"))
    return F.coalesce(F.when(text.rlike(ISO), exact), day)


def date_key(moment: Column) -> Column:
    """Day as the integer yyyymmdd."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def days_between(end: Column, start: Column) -> Column:
    """Whole days from start to end: negative when reversed, null when open."""
    return F.datediff(end, start.cast("date"))
