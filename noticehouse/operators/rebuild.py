"""Silver and its full history, recomputed from the stored messages.

Gives what running every batch through the upsert in order would give, as window
expressions over one shuffle. Each batch is first cut to one row per key, so a
key's window holds at most one row per batch, however many messages it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticehouse.operators.clean import silver_rows
from noticehouse.operators.dedup import latest_versions
from noticehouse.operators.merge import DIGEST, with_digest
from noticehouse.spec import FeedSpec

# Names of the snapshot's interval columns.
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"

_KEY = "_key"


def replay_history(
    rows: DataFrame, spec: FeedSpec, batch: str, stamp: Column, strict_noop: bool = False
) -> DataFrame:
    """Every state each key went through, with its validity interval.

    ``rows`` are keyed silver rows of many batches; ``stamp`` is the time of the
    row's batch, growing with ``batch``.
    """
    newest = latest_versions(rows, spec, within=[batch]).transform(with_digest, spec)
    return _states(newest, spec, batch, stamp, strict_noop)


def replay_columns(
    messages: DataFrame,
    spec: FeedSpec,
    batch: str,
    stamp: Column,
    columns: Sequence[str],
    strict_noop: bool = False,
    dealt: Sequence[str] = (),
) -> DataFrame:
    """The same states from the messages themselves, of which some columns are wanted.

    Only what tells key and order is parsed before the first shuffle, which moves it
    with the text; the newest message of each key and batch is then parsed in full,
    and the second shuffle moves the wanted columns and the content digest. Where the
    payload is wanted, it moves in place of what is parsed from it.

    ``dealt`` names message columns that the messages are partitioned by. One message
    of each key, batch and value of these is then taken where it lies, so that a hot
    key is few rows, and the text moves once, to the key.
    """
    keyed = silver_rows(messages, spec.ordering, [batch, *dealt])
    if dealt:
        keyed = latest_versions(keyed, spec, within=[*dealt, batch]).drop(*dealt).repartition(spec.key)
    newest = latest_versions(keyed, spec, within=[batch])
    # The key by another name, so that what lies by it is known to lie so after the parse.
    texts = newest.select(F.col(spec.payload).alias("value"), batch, F.col(spec.key).alias(_KEY))
    typed = silver_rows(texts, spec, [batch, _KEY]).transform(with_digest, spec)
    stamps = (spec.inserted_at, spec.updated_at)
    made = (spec.key, spec.version, DIGEST, *stamps)
    whole = spec.payload in columns
    needed = [spec.payload] if whole else [c for c in columns if c not in made]
    narrow = typed.select(F.col(_KEY).alias(spec.key), spec.version, batch, DIGEST, *needed)
    states = _states(narrow, spec, batch, stamp, strict_noop)
    if whole:
        kept = [DIGEST, *stamps, VALID_FROM, VALID_TO]
        states = silver_rows(states.select(F.col(spec.payload).alias("value"), *kept), spec, kept)
    return states.select(*columns, VALID_FROM, VALID_TO)


def _states(
    newest: DataFrame, spec: FeedSpec, batch: str, stamp: Column, strict_noop: bool
) -> DataFrame:
    by_key = Window.partitionBy(spec.key).orderBy(batch)
    version = F.col(spec.version)
    best = F.max(spec.version).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    # Never stale: no version seen so far, or at least the highest one.
    accepted = F.when(best.isNull(), True).otherwise(F.coalesce(version >= best, F.lit(False)))

    before, digest = F.lag(version).over(by_key), F.lag(DIGEST).over(by_key)
    differs = F.col(DIGEST) != digest
    unversioned = before.isNull() & (
        version.isNotNull() | differs if strict_noop else F.lit(True)
    )
    effective = digest.isNull() | unversioned | (version > before) | differs

    return (
        newest.withColumn("_accepted", accepted)
        .where("_accepted")
        .withColumn("_effective", effective)
        .where("_effective")
        .withColumn(spec.updated_at, stamp)
        .withColumn(spec.inserted_at, F.first(spec.updated_at).over(by_key))
        .withColumn(VALID_FROM, F.col(spec.updated_at))
        .withColumn(VALID_TO, F.lead(spec.updated_at).over(by_key))
        .drop("_accepted", "_effective", batch)
    )


def rebuild_silver(
    rows: DataFrame, spec: FeedSpec, batch: str, stamp: Column, strict_noop: bool = False
) -> DataFrame:
    """Current state: the last entry of every key's history."""
    return (
        replay_history(rows, spec, batch, stamp, strict_noop)
        .where(F.col(VALID_TO).isNull())
        .drop(VALID_FROM, VALID_TO)
    )
