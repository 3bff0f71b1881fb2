"""Gold: type-1 dimensions and the fact over the snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticehouse.functions.dates import date_key, days_between
from noticehouse.functions.keys import UNKNOWN_LABEL, surrogate_key, unknown_key
from noticehouse.functions.payload import array_length
from noticehouse.operators.history import interval_columns
from noticehouse.operators.rebuild import VALID_FROM
from noticehouse.spec import DimSpec, FeedSpec


def staging_view(silver: DataFrame, spec: FeedSpec, name: str | None = None) -> DataFrame:
    """The silver columns gold reads, optionally as a temporary view."""
    staged = silver.select(*spec.staging_columns)
    if name:
        staged.createOrReplaceTempView(name)
    return staged


def dimension(staged: DataFrame, dim: DimSpec) -> DataFrame:
    """Distinct attribute tuples with a hashed key, and the unknown member.

    The distinct combines inside the map tasks, so a popular value is shuffled
    once per task.
    """
    known = (
        staged.where(F.col(dim.required).isNotNull())
        .select(*(F.col(c).alias(out) for c, out in dim.columns.items()))
        .distinct()
        .select(surrogate_key(*map(F.col, dim.columns.values())).alias(dim.key), "*")
    )
    return known.unionByName(unknown_member(staged.sparkSession, dim))


def unknown_member(spark: SparkSession, dim: DimSpec) -> DataFrame:
    def value(column: str) -> Column:
        label = UNKNOWN_LABEL if column == dim.label else None
        return F.lit(label).cast("string").alias(column)

    return spark.range(1).select(
        unknown_key(dim.name).alias(dim.key), *map(value, dim.columns.values())
    )


def dimensions(staged: DataFrame, spec: FeedSpec) -> dict[str, DataFrame]:
    return {dim.name: dimension(staged, dim) for dim in spec.fact.dims}


def lookup(facts: DataFrame, members: DataFrame, dim: DimSpec) -> DataFrame:
    """Add the dimension's key by null-safe match on all its attributes; null
    where none matches.

    Dimensions are unique on their attributes, so rows never multiply. Spark
    broadcasts a dimension by its measured size; a larger one is a shuffle join,
    whose hot partitions adaptive execution splits on the fact side.
    """
    theirs = {c: f"_{dim.key}_{out}" for c, out in dim.columns.items()}
    renamed = members.select(
        dim.key, *(F.col(out).alias(theirs[c]) for c, out in dim.columns.items())
    )

    def matches(column: str) -> Column:
        mine, other = F.col(column), F.col(theirs[column])
        # Never null in a dimension: plain equality finds the same rows.
        return mine == other if column == dim.required else mine.eqNullSafe(other)

    return facts.join(renamed, list(map(matches, dim.columns)), "left").drop(*theirs.values())


def own_key(facts: DataFrame, dim: DimSpec) -> DataFrame:
    """Add the key the row's own attributes hash to: what a lookup would find in
    a dimension made from these very rows, without the join."""
    key = surrogate_key(*map(F.col, dim.columns))
    return facts.withColumn(dim.key, F.when(F.col(dim.required).isNotNull(), key))


def with_fallback(dim: DimSpec) -> Column:
    """Foreign key, with the unknown member where the lookup found nothing."""
    return F.coalesce(F.col(dim.key), unknown_key(dim.name)).alias(dim.key)


def fact_columns(spec: FeedSpec) -> set[str]:
    """Silver columns that the fact is made from."""
    shape = spec.fact
    attributes = (c for dim in shape.dims for c in dim.columns)
    ends = (shape.array_count[0], shape.duration[0])
    return {spec.key, spec.event_time, spec.updated_at, *shape.carried, *ends, *attributes}


def fact(
    snapshot: DataFrame, members: Mapping[str, DataFrame] | None, spec: FeedSpec
) -> DataFrame:
    """One row per version of a notice.

    Without ``members`` the dimensions are taken to come from this snapshot
    itself; every attribute is then found, and nothing needs to be joined.
    """
    shape = spec.fact
    items, item_count = shape.array_count
    end, duration = shape.duration
    moment = F.col(spec.event_time)
    attributes = {c: None for dim in shape.dims for c in dim.columns}
    rows = snapshot.select(
        surrogate_key(F.col(spec.key), F.col(VALID_FROM)).alias(shape.key),
        *shape.carried,
        date_key(moment).alias("date_key"),
        array_length(F.col(items)).alias(item_count),
        days_between(F.col(end), moment).alias(duration),
        *interval_columns(),
        *attributes,
    )
    for dim in shape.dims:
        rows = own_key(rows, dim) if members is None else lookup(rows, members[dim.name], dim)
    return rows.select(
        shape.key,
        *shape.carried,
        "date_key",
        *map(with_fallback, shape.dims),
        item_count,
        duration,
        "valid_from",
        "valid_to",
        "is_current",
    )
