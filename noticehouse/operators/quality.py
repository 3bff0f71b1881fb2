"""Data tests: each gives the rows (or values) that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.spec import FeedSpec


@dataclass(frozen=True)
class Relationship:
    """Every non-null ``column`` of ``child`` must be a ``field`` of ``parent``."""

    child: str
    column: str
    parent: str
    field: str


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Failures of not-null for many columns, in one pass over the table."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns)
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(pairs))


#: What is counted while a table is written; without a column, its rows.
OBSERVED = "table_name string, column_name string, counted bigint"


def observed_nulls(observed: DataFrame) -> DataFrame:
    """Failures of not-null, from what was counted while writing."""
    named = observed.where(F.col("column_name").isNotNull())
    return named.select("table_name", "column_name", F.col("counted").alias("failures"))


def duplicate_counts(df: DataFrame, table: str, column: str) -> DataFrame:
    """How many values occur more than once; nulls do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("failures"))
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "failures")
    )


def orphan_counts(tables: Mapping[str, DataFrame], rules: Sequence[Relationship]) -> DataFrame:
    """How many rows of one child table point nowhere, for all its rules at once.

    One scan turns the child's keys into (rule, value) pairs and counts them
    inside the map tasks; the anti join then meets each value once, so a hot key
    weighs no more than a rare one.
    """
    (child,) = {rule.child for rule in rules}
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("rule"), F.col(r.column).cast("string").alias("value"))
            for i, r in enumerate(rules)
        )
    )
    counted = (
        tables[child]
        .select(F.inline(keys))
        .where("value is not null")
        .groupBy("rule", "value")
        .agg(F.count("*").alias("_n"))
    )
    known = union_all(
        [
            tables[r.parent].select(
                F.lit(i).alias("rule"), F.col(r.field).cast("string").alias("value")
            )
            for i, r in enumerate(rules)
        ]
    )
    orphans = counted.join(known, ["rule", "value"], "left_anti")
    found = orphans.groupBy("rule").agg(F.sum("_n").alias("_failures"))
    listed = F.array(
        *(
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(r.child).alias("table_name"),
                F.lit(r.column).alias("column_name"),
                F.lit(r.parent).alias("parent_table"),
            )
            for i, r in enumerate(rules)
        )
    )
    return (
        tables[child]
        .sparkSession.range(1)
        .select(F.inline(listed))
        .join(found, "rule", "left")
        .select(
            "table_name",
            "column_name",
            "parent_table",
            F.coalesce("_failures", F.lit(0)).alias("failures"),
        )
    )


def not_null_columns(spec: FeedSpec) -> dict[str, list[str]]:
    """Table -> columns the warehouse requires to be filled."""
    fact = spec.fact
    rules = {dim.name: [dim.key] for dim in fact.dims}
    rules[fact.date_dim] = ["date_key"]
    rules[fact.name] = [fact.key, "date_key", *(dim.key for dim in fact.dims)]
    return rules


def unique_columns(spec: FeedSpec) -> dict[str, str]:
    fact = spec.fact
    return {
        **{dim.name: dim.key for dim in fact.dims},
        fact.date_dim: "date_key",
        fact.name: fact.key,
    }


def relationships(spec: FeedSpec) -> list[Relationship]:
    fact = spec.fact
    to_dims = [Relationship(fact.name, d.key, d.name, d.key) for d in fact.dims]
    return [Relationship(fact.name, "date_key", fact.date_dim, "date_key"), *to_dims]


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def run_tests(
    silver: DataFrame,
    gold: dict[str, DataFrame],
    spec: FeedSpec,
    observed: DataFrame | None = None,
) -> DataFrame:
    """All tests of the warehouse: one row per rule with its failure count. With what
    was ``observed`` while gold was written, its tables are not scanned for nulls."""
    rules = not_null_columns(spec)
    if observed is None:
        nulls = [null_counts(gold[table], table, columns) for table, columns in rules.items()]
    else:
        nulls = [observed_nulls(observed)]
    nulls.append(null_counts(silver, "silver", [spec.key]))
    doubles = [
        duplicate_counts(gold[table], table, column)
        for table, column in unique_columns(spec).items()
    ]
    doubles.append(duplicate_counts(silver, "silver", spec.key))
    orphans = [orphan_counts(gold, relationships(spec)).drop("parent_table")]
    named = {"not_null": nulls, "unique": doubles, "relationships": orphans}
    return union_all(
        [
            part.select(F.lit(test).alias("test"), "*")
            for test, parts in named.items()
            for part in parts
        ]
    )
