"""Member and group counts, maintained from the change sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.operators import deltas
from noticehouse.session import empty, scratch_path
from noticehouse.sources.store import SEQ, Store

LAYER = "counts"


def update_counts(store: Store) -> None:
    """Append what the batches since the last update changed per group.

    Reads the change sets since then, and the rows that their keys had before; of
    silver only the row groups of these keys.
    """
    spec, ledger = store.spec, store.ledger()
    upto, since = ledger.last("silver"), ledger.last(LAYER)
    if upto is None or upto == since:
        return
    columns = [spec.key, *deltas.grouped_columns(spec)]
    after = store.newest_changes(since, upto, ledger).select(*columns)
    first = 0 if since is None else since + 1
    before = store.stored_for(after.select(spec.key), first, columns, ledger)
    path = scratch_path(store.spark, "signed-rows")
    deltas.signed(before, after).write.parquet(path)
    rows = store.spark.read.parquet(path)
    for name, by in deltas.groupings(spec).items():
        named = rows.select(*(c.alias(n) for n, c in by.items()), deltas.SIGN)
        store.put(deltas.summed(named, list(by)), f"{LAYER}/{name}", upto)
    store.commit((LAYER, upto), ledger=ledger)


def counts(store: Store, name: str) -> DataFrame:
    """Current rows per group, as of the last update."""
    upto, by = store.last(LAYER), deltas.groupings(store.spec)[name]
    shape = empty(store.spark, store.spec.silver_schema).select(*(c.alias(n) for n, c in by.items()))
    schema = shape.withColumn(deltas.ROWS, F.lit(0).cast("bigint")).schema
    sets = store.batches(f"{LAYER}/{name}", schema).where(F.col(SEQ) <= (-1 if upto is None else upto))
    return deltas.summed(sets, list(by), deltas.ROWS)
