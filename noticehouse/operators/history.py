"""SCD2: validity intervals per key, sampled from the current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticehouse.operators.rebuild import VALID_FROM, VALID_TO
from noticehouse.spec import FeedSpec

# Names of the snapshot's other columns.
ROW_ID = "dbt_scd_id"
UPDATED = "dbt_updated_at"


def snapshot_source(
    silver: DataFrame, spec: FeedSpec, without: Sequence[str] = ()
) -> DataFrame:
    """Silver as the snapshot reads it: all columns but those named, the update
    stamp without its zone."""
    return silver.drop(*without).withColumn(
        spec.updated_at, F.col(spec.updated_at).cast("timestamp_ntz")
    )


def open_versions(source: DataFrame, spec: FeedSpec) -> DataFrame:
    """Source rows as open versions, valid from their own stamp."""
    stamp = F.col(spec.updated_at)
    return source.withColumns(
        {
            ROW_ID: F.md5(F.concat_ws("|", F.col(spec.key), stamp.cast("string"))),
            UPDATED: stamp,
            VALID_FROM: stamp,
            VALID_TO: F.lit(None).cast("timestamp_ntz"),
        }
    )


def take_snapshot(history: DataFrame, source: DataFrame, spec: FeedSpec) -> DataFrame:
    """The history after one more look at the source.

    A new key opens a row. A newer stamp closes the open row at that stamp and
    opens another. The same stamp does nothing, and a key that is gone stays
    open. History and source are read once and joined once: only open rows meet the
    source, and each row or pair gives one row or two.
    """
    key = spec.key
    opened = open_versions(source, spec).select(*history.columns)
    old, new = (lambda c: F.col(f"h.{c}")), (lambda c: F.col(f"s.{c}"))
    newer = new(VALID_FROM) > old(VALID_FROM)
    kept = [
        (F.when(newer, new(VALID_FROM)).otherwise(old(c)) if c == VALID_TO else old(c)).alias(c)
        for c in history.columns
    ]
    rows = F.array_compact(
        F.array(
            F.when(old(VALID_FROM).isNotNull(), F.struct(*kept)),
            F.when(
                new(VALID_FROM).isNotNull() & (old(VALID_FROM).isNull() | newer),
                F.struct(*(new(c).alias(c) for c in history.columns)),
            ),
        )
    )
    meets = (old(key) == new(key)) & old(VALID_TO).isNull()
    joined = history.alias("h").join(opened.alias("s"), meets, "full_outer")
    return joined.select(F.inline(rows))


def closed_versions(before: DataFrame, newer: DataFrame, spec: FeedSpec) -> DataFrame:
    """The earlier versions of changed keys, closed at the stamp of the newer ones.

    ``before`` and ``newer`` hold one row per key, of ``newer`` only key and stamp
    are read. Where the newer stamp is not later there is nothing to close: the
    newer row takes the earlier one's place.
    """
    opened = open_versions(snapshot_source(before, spec), spec)
    at = F.col(spec.updated_at).cast("timestamp_ntz").alias("_at")
    met = opened.join(newer.select(spec.key, at), spec.key)
    return met.where(F.col("_at") > F.col(VALID_FROM)).withColumn(VALID_TO, F.col("_at")).select(*opened.columns)


def intervals_from_versions(versions: DataFrame, spec: FeedSpec) -> DataFrame:
    """Validity intervals of append-only versions: each ends where the key's
    next begins. A key has at most one version per snapshot run."""
    by_key = Window.partitionBy(spec.key).orderBy(VALID_FROM)
    return versions.withColumn(VALID_TO, F.lead(VALID_FROM).over(by_key))


def interval_columns() -> list[Column]:
    """How the fact shows the interval."""
    return [
        F.col(VALID_FROM).alias("valid_from"),
        F.col(VALID_TO).alias("valid_to"),
        F.col(VALID_TO).isNull().alias("is_current"),
    ]
