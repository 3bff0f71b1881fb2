"""Versioned upsert: what a batch does to the current state.

Both sides hold one row per key, so no key can be hot here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticehouse.functions.payload import content_digest, differs
from noticehouse.operators.dedup import drop_duplicate_keys
from noticehouse.spec import FeedSpec

INSERTED = "inserted"
UPDATED_NEWER = "updated_newer"
UPDATED_CONTENT = "updated_content"
UPDATED_UNVERSIONED = "updated_unversioned"
IGNORED_STALE = "ignored_stale"
IGNORED_SAME = "ignored_same"
EFFECTIVE = (INSERTED, UPDATED_NEWER, UPDATED_CONTENT, UPDATED_UNVERSIONED)

DIGEST = "_content_digest"
# Fixed value: the batch that legacy rows are put under.
BACKFILL = "backfill_dev"


def with_digest(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Add the content digest, so that a later merge reads that one column."""
    return df.withColumn(DIGEST, content_digest(spec.diff_columns))


def content_changed(spec: FeedSpec, stored: str = "s", incoming: str = "i") -> Column:
    """Null-safe difference in any content column of two aliased sides."""
    return differs(
        [F.col(f"{stored}.{c}") for c in spec.diff_columns],
        [F.col(f"{incoming}.{c}") for c in spec.diff_columns],
    )


def outcome(
    is_new: Column,
    stored_version: Column,
    version: Column,
    changed: Column,
    strict_noop: bool = False,
) -> Column:
    """Class of an incoming row against the stored row of its key.

    A stored row without a version gives way to anything, unchanged content
    included; ``strict_noop`` leaves it alone when nothing differs. Against a
    stored version, a missing or lower one is stale.
    """
    nothing_new = stored_version.isNull() & version.isNull() & ~changed
    return (
        F.when(is_new, INSERTED)
        .when(F.lit(strict_noop) & nothing_new, IGNORED_SAME)
        .when(stored_version.isNull(), UPDATED_UNVERSIONED)
        .when(version.isNull() | (version < stored_version), IGNORED_STALE)
        .when(version > stored_version, UPDATED_NEWER)
        .when(changed, UPDATED_CONTENT)
        .otherwise(IGNORED_SAME)
    )


def upsert_outcomes(
    stored: DataFrame, incoming: DataFrame, spec: FeedSpec, strict_noop: bool = False
) -> DataFrame:
    """Incoming rows with their class and the stored ``inserted_at``.

    Reads four narrow columns of the stored side when it carries digests; a stored
    row without one counts as different. The stored rows are cut down to the
    incoming keys first: with a small batch that is a broadcast, and a large state
    is never shuffled.
    """
    key, version = spec.key, spec.version
    if DIGEST in stored.columns:
        incoming = incoming if DIGEST in incoming.columns else with_digest(incoming, spec)
        same = F.col(f"s.{DIGEST}").eqNullSafe(F.col(f"i.{DIGEST}"))
        content, changed = [DIGEST], ~same
    else:
        content, changed = list(spec.diff_columns), content_changed(spec)
    columns = merge_columns(spec, content)
    hits = stored.select(*columns).join(incoming.select(key), key, "left_semi")
    same_key = F.col(f"s.{key}") == F.col(f"i.{key}")
    return (
        incoming.alias("i")
        .join(hits.alias("s"), same_key, "left")
        .select(
            "i.*",
            F.col(f"s.{spec.inserted_at}").alias(spec.inserted_at),
            outcome(
                F.col(f"s.{key}").isNull(),
                F.col(f"s.{version}"),
                F.col(f"i.{version}"),
                changed,
                strict_noop,
            ).alias("outcome"),
        )
    )


def merge_columns(spec: FeedSpec, content: Sequence[str] = (DIGEST,)) -> list[str]:
    """What a merge needs to know of a stored row."""
    return list(dict.fromkeys([spec.key, spec.version, spec.inserted_at, *content]))


def overlay(stored: DataFrame, changes: DataFrame, spec: FeedSpec) -> DataFrame:
    """The whole state: stored rows whose key did not change, and the changes."""
    untouched = stored.join(changes.select(spec.key), spec.key, "left_anti")
    return untouched.select(*changes.columns).unionByName(changes)


def upsert_changes(
    stored: DataFrame,
    incoming: DataFrame,
    spec: FeedSpec,
    now: Column,
    strict_noop: bool = False,
) -> DataFrame:
    """Only the rows the batch inserts or rewrites, stamped."""
    return (
        upsert_outcomes(stored, incoming, spec, strict_noop)
        .where(F.col("outcome").isin(*EFFECTIVE))
        .withColumns(
            {
                spec.inserted_at: F.coalesce(F.col(spec.inserted_at), now),
                spec.updated_at: now,
            }
        )
        .drop("outcome")
    )


def backfill_bronze(legacy: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rows of a legacy current-state table as bronze rows."""
    return legacy.select(
        spec.key,
        spec.api_id,
        *spec.key_fields,
        spec.version,
        spec.event_time,
        # Names of the bronze columns.
        F.coalesce(F.col(spec.payload), F.lit("{}")).alias("raw_json"),
        F.col(spec.inserted_at).alias("_ingested_at"),
        F.lit(BACKFILL).alias("_batch_id"),
    )


def backfill_silver(stored: DataFrame, legacy: DataFrame, spec: FeedSpec) -> DataFrame:
    """Add legacy rows whose key silver does not have; stored keys stay untouched.

    Of legacy rows with one key the newest version is added. Null keys conflict
    with nothing, so they are all added.
    """
    columns = [*spec.silver_columns, spec.key, spec.inserted_at, spec.updated_at]
    return stored.select(*columns).unionByName(
        backfilled(stored, legacy, spec).select(*columns)
    )


def backfilled(stored: DataFrame, legacy: DataFrame, spec: FeedSpec) -> DataFrame:
    """The rows that a backfill adds."""
    return (
        drop_duplicate_keys(legacy, spec)
        .join(stored.select(spec.key), spec.key, "left_anti")
        .withColumn(spec.updated_at, F.col(spec.inserted_at))
    )
