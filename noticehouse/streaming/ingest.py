"""Messages to bronze and silver, batch by batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from noticehouse.operators.bronze import INGESTED, batch_stamp, bronze_rows, newest_messages
from noticehouse.operators.clean import silver_rows
from noticehouse.operators.merge import upsert_changes, with_digest
from noticehouse.sources.store import Ledger, Store

Clock = Callable[[int], Column]


def wall_clock(_seq: int) -> Column:
    """One time for the whole batch, read on the driver."""
    return F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")


def land_batch(
    store: Store,
    messages: DataFrame,
    stream: str,
    batch: int,
    clock: Clock,
    ledger: Ledger | None = None,
) -> int:
    """Append every message of the batch to bronze; a batch that landed before stays
    as it is. Returns its number in the store."""
    ledger = ledger or store.ledger()
    seq = ledger.landed(stream, batch)
    if seq is None:
        last = ledger.last("bronze")
        seq = 0 if last is None else last + 1
        stamp = batch_stamp(stream, F.lit(batch))
        store.put(bronze_rows(messages, store.spec, stamp, clock(seq)), "bronze", seq)
        store.commit(("bronze", seq, stream, batch), ledger=ledger)
    return seq


def merge_batch(
    store: Store, seq: int, strict_noop: bool = False, ledger: Ledger | None = None
) -> None:
    """Upsert a landed batch into silver, stamped with the time it landed.

    Reads the batch back from bronze: the source is read once, and a lost
    executor costs a re-read of a table, not of the topic.
    """
    spec, ledger = store.spec, ledger or store.ledger()
    batch = store.bronze_batch(seq)
    now = F.lit(batch.agg(F.max(INGESTED)).first()[0]).cast("timestamp")
    incoming = silver_rows(newest_messages(batch, spec), spec).transform(with_digest, spec)
    incoming = incoming.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stored = store.stored_for(incoming.select(spec.key), before=seq, ledger=ledger)
        changes = upsert_changes(stored, incoming, spec, now, strict_noop)
        store.put(changes, "silver/changes", seq)
        store.commit(("silver", seq), ledger=ledger)
    finally:
        incoming.unpersist()
    store.compact_if_due(seq, ledger)


def ingest_batch(
    store: Store, messages: DataFrame, stream: str, batch: int, clock: Clock, **options: bool
) -> None:
    """One micro-batch. Running it again changes nothing.

    Batches are merged in the order they landed, so one that a failure left behind
    is merged first. The ledger is read once.
    """
    if messages.isEmpty():
        return
    ledger = store.ledger()
    land_batch(store, messages, stream, batch, clock, ledger)
    for seq in ledger.unmerged():
        merge_batch(store, seq, ledger=ledger, **options)


def start_ingest(
    store: Store,
    messages: DataFrame,
    stream: int = 0,
    clock: Clock = wall_clock,
    **options: bool,
) -> StreamingQuery:
    """Consume what the source holds, then stop; the checkpoint remembers where.

    ``stream`` numbers the checkpoint. To read the source from its start again,
    take a number not used before: its batches then never count as repeated.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        here = store.within(batch.sparkSession)
        ingest_batch(here, batch, f"stream{stream}", batch_id, clock, **options)

    return (
        messages.writeStream.foreachBatch(process)
        .option("checkpointLocation", store.checkpoint(stream))
        .trigger(availableNow=True)
        .start()
    )


def ingest_available(store: Store, messages: DataFrame, **options) -> None:
    start_ingest(store, messages, **options).awaitTermination()
