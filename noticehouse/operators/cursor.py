"""Incremental pulls: where to read from next."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# First cursor, overlap between pulls, rows a source gives at most.
DEFAULT_CURSOR = "1900-01-01"
OVERLAP_DAYS = 1
PULL_LIMIT = 10_000

EXHAUSTED = "exhausted"
ADVANCED = "advanced"
STUCK = "stuck"


class CursorStuck(RuntimeError):
    """A capped pull ended where it began, so the next one would loop."""


def _day(moment: Column, overlap_days: int) -> Column:
    return F.date_format(F.date_sub(moment.cast("date"), overlap_days), "yyyy-MM-dd")


def next_cursor(
    records: DataFrame, moment: Column, cursor: str, overlap_days: int = OVERLAP_DAYS
) -> DataFrame:
    """One row: the newest valid day less the overlap, or the old cursor when no
    record has a valid date."""
    newest = F.max(moment)
    return records.agg(
        F.coalesce(_day(newest, overlap_days), F.lit(cursor)).alias("next_cursor")
    )


def newer_than(records: DataFrame, moment: Column, cursor: str) -> DataFrame:
    """Records after the cursor day's start. On a typed column of a columnar
    source this is a pushed-down filter."""
    return records.where(moment > F.lit(cursor).cast("timestamp_ntz"))


def incremental(records: DataFrame, moment: Column, cursor: str) -> DataFrame:
    """Records after the cursor, oldest first.

    Records of one moment come in the order of a hash: with it the range
    partitions can cut a moment that holds a large share of all rows.
    """
    spread = F.xxhash64(*records.columns)
    return newer_than(records, moment, cursor).orderBy(moment, spread)


def pull_status(
    records: DataFrame,
    moment: Column,
    cursor: str,
    limit: int = PULL_LIMIT,
    overlap_days: int = OVERLAP_DAYS,
) -> DataFrame:
    """One row on a pull from a source that gives at most ``limit`` rows: how many
    came, where the next pull starts, and whether that makes progress."""
    page = newer_than(records.select(moment.alias("_at")), F.col("_at"), cursor)
    pulled = page.orderBy("_at").limit(limit).agg(
        F.count("*").alias("pulled"), _day(F.max("_at"), overlap_days).alias("_next")
    )
    full = F.col("pulled") >= limit
    status = (
        F.when(~full, EXHAUSTED)
        .when(F.col("_next") <= cursor, STUCK)
        .otherwise(ADVANCED)
    )
    return pulled.select(
        F.lit(cursor).alias("cursor"),
        "pulled",
        status.alias("status"),
        F.when(full, F.col("_next")).otherwise(F.lit(cursor)).alias("next_cursor"),
    )


@dataclass(frozen=True)
class Advance:
    cursor: str
    more: bool


def advance(records: DataFrame, moment: Column, cursor: str, **limits: int) -> Advance:
    """The next cursor of a capped pull; raises when it would not advance."""
    row = pull_status(records, moment, cursor, **limits).first()
    if row.status == STUCK:
        raise CursorStuck(f"pull from {cursor} is {row.status} after {row.pulled} rows")
    return Advance(row.next_cursor, row.status == ADVANCED)


def day_counts(records: DataFrame, moment: Column) -> DataFrame:
    """``day``, its rows, and those at its very start, which a pull from that day
    leaves out. A row per day, however many records there are."""
    counted = records.select(moment.alias("_at")).where(F.col("_at").isNotNull())
    moment, day = F.col("_at"), F.col("_at").cast("date")
    at_start = F.count_if(moment == day.cast("timestamp_ntz"))
    return counted.groupBy(day.alias("day")).agg(F.count("*").alias("n"), at_start.alias("at_start"))


def pages(
    records: DataFrame,
    moment: Column,
    cursor: str,
    limit: int = PULL_LIMIT,
    overlap_days: int = OVERLAP_DAYS,
) -> list[Row]:
    """The status rows of a capped pull from its first page to its last, or to the
    one where it is stuck.

    The records are read once, for all pages: where a page ends follows from the
    number of records per day.
    """
    counted = sorted(day_counts(records, moment).collect())
    days = [r.day for r in counted]
    before = [0, *accumulate(r.n for r in counted)]
    shape = Row("cursor", "pulled", "status", "next_cursor")
    found: list[Row] = []
    while True:
        start = dt.date.fromisoformat(cursor)
        at = bisect_left(days, start)
        left_out = counted[at].at_start if at < len(days) and days[at] == start else 0
        skipped = before[at] + left_out
        pulled = min(limit, before[-1] - skipped)
        if pulled < limit:
            return [*found, shape(cursor, pulled, EXHAUSTED, cursor)]
        last = days[bisect_left(before, skipped + limit) - 1] if limit else start
        following = (last - dt.timedelta(overlap_days)).isoformat()
        status = STUCK if following <= cursor else ADVANCED
        found.append(shape(cursor, pulled, status, following))
        if status == STUCK:
            return found
        cursor = following
