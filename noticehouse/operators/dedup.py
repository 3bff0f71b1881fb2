"""One row per key.

Every form here reduces inside the map tasks before anything is shuffled, so a
key with a third of all rows costs one row per task, not one giant task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticehouse.functions.keys import first_present
from noticehouse.spec import FeedSpec


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key. Catalyst plans the filtered row number as a group
    limit before and after the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_versions(
    df: DataFrame, spec: FeedSpec, within: Sequence[str] = ()
) -> DataFrame:
    """Newest version of each key (per ``within`` group, such as a batch).

    The payload is the last sort key: a lost and re-run task then picks the same
    row of a tie.
    """
    by = (spec.version, spec.event_time, spec.api_id, spec.payload)
    present = [F.col(c).desc_nulls_last() for c in by if c in df.columns]
    return top_row(df, [*within, spec.key], present)


def keep_last(records: DataFrame, key: str, position: str) -> DataFrame:
    """Last occurrence of each key, with the position of its first occurrence:
    an ordered dictionary's rule. Sort by ``first_<position>`` to get its order.

    Only narrow columns are hashed and only one wide row per key and task moves.
    """
    firsts = records.groupBy(F.col(key).alias("_key")).agg(
        F.min(position).alias(f"first_{position}")
    )
    last = top_row(records, [key], [F.col(position).desc()])
    joined = last.join(firsts, F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(*records.columns, f"first_{position}")


def backfill_key(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Fill the key where it is null; rows without any identifier keep null."""
    identifiers = map(F.col, (*spec.key_fields, spec.api_id))
    return df.withColumn(
        spec.key, F.coalesce(F.col(spec.key), first_present(*identifiers))
    )


def drop_duplicate_keys(
    df: DataFrame, spec: FeedSpec, row_id: str | None = None
) -> DataFrame:
    """Keep the newest version (then the newest row) of each key. Without a
    ``row_id`` the newest row is the one inserted last, then the larger payload.

    Rows with a null key are no duplicates of each other; they bypass the
    shuffle instead of meeting in one partition.
    """
    key = F.col(spec.key)
    newest = [row_id] if row_id else [spec.inserted_at, spec.payload]
    order = [F.col(c).desc_nulls_last() for c in (spec.version, *newest)]
    keyed = top_row(df.where(key.isNotNull()), [spec.key], order)
    return keyed.unionByName(df.where(key.isNull()))
