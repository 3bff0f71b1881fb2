"""Counts per group, kept up to date from signed rows.

An update takes its old row's group one down and its new row's one up. Summed per
group, what did not change its group is gone before anything is stored. A group is
a member as long as its count is above zero, so DISTINCT survives updates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticehouse.functions.dates import date_key
from noticehouse.functions.keys import UNKNOWN_LABEL, surrogate_key
from noticehouse.operators.star import unknown_member
from noticehouse.spec import DimSpec, FeedSpec

SIGN, ROWS = "_sign", "n"
BY_DAY = "by_day"


def signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows that go, and those that come in their place."""
    gone = before.withColumn(SIGN, F.lit(-1).cast("bigint"))
    return gone.unionByName(after.withColumn(SIGN, F.lit(1).cast("bigint")))


def summed(rows: DataFrame, by: Sequence[str], sign: str = SIGN) -> DataFrame:
    """Net change per group; null is a group."""
    totals = rows.groupBy(*by).agg(F.sum(sign).alias(ROWS))
    return totals.where(F.col(ROWS) != 0)


def groupings(spec: FeedSpec) -> dict[str, dict[str, Column]]:
    """What is counted: the attributes of each dimension, and the day."""
    found = {
        dim.name: {out: F.col(c) for c, out in dim.columns.items()} for dim in spec.fact.dims
    }
    return {**found, BY_DAY: {"date_key": date_key(F.col(spec.event_time))}}


def grouped_columns(spec: FeedSpec) -> list[str]:
    """Silver columns that the groupings read."""
    return list(dict.fromkeys([*(c for d in spec.fact.dims for c in d.columns), spec.event_time]))


def members(counts: DataFrame, dim: DimSpec) -> DataFrame:
    """The dimension, from the counts of its attributes."""
    known = counts.where(F.col(dim.label).isNotNull() & (F.col(ROWS) > 0)).select(
        surrogate_key(*map(F.col, dim.columns.values())).alias(dim.key), *dim.columns.values()
    )
    return known.unionByName(unknown_member(counts.sparkSession, dim))


def per_value(counts: DataFrame, dim: DimSpec, column: str) -> DataFrame:
    """Rows per value of an attribute; those of the unknown member are Unknown."""
    value = F.when(F.col(dim.label).isNotNull(), F.col(column))
    named = counts.select(F.coalesce(value, F.lit(UNKNOWN_LABEL)).alias(column), ROWS)
    return named.groupBy(column).agg(F.sum(ROWS).alias(ROWS)).where(F.col(ROWS) != 0)


def per_month(counts: DataFrame, dates: DataFrame) -> DataFrame:
    joined = counts.join(dates.select("date_key", "year", "month"), "date_key")
    return joined.groupBy("year", "month").agg(F.sum(ROWS).alias(ROWS)).where(F.col(ROWS) != 0)
