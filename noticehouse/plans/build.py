"""Steps from silver to gold, and the pull that feeds the landing folder."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from noticehouse.functions.dates import parse_publication
from noticehouse.operators import calendar, cursor, history, quality, star
from noticehouse.operators.bronze import INGESTED
from noticehouse.operators.clean import RAW, silver_rows, with_producer_key
from noticehouse.operators.dedup import backfill_key, keep_last
from noticehouse.operators.merge import DIGEST, backfill_bronze, backfilled, with_digest
from noticehouse.operators.rebuild import VALID_FROM, VALID_TO, replay_history
from noticehouse.sources.messages import envelope, write_messages
from noticehouse.session import scratch_path
from noticehouse.sources.store import MIGRATION, SEQ, Store
from noticehouse.spec import FeedSpec
from noticehouse.streaming.ingest import merge_batch


class TestsFailed(RuntimeError):
    """Some data tests found failing rows."""


@dataclass(frozen=True)
class Pull:
    """Where the next pull starts, the pages this one took, and the records it left
    out because their date is none."""

    cursor: str
    pages: int
    undated: int


def pull_records(
    store: Store,
    records: DataFrame,
    position: str,
    landing: str,
    file_format: str = "text",
    fetched_at: Column | None = None,
    limit: int | None = None,
) -> Pull:
    """Land the records newer than the cursor, then move the cursor.

    With a ``limit``, a page holds the oldest so many records, and pages follow
    until one is not full; :class:`cursor.CursorStuck` is raised where a full page
    does not move the cursor. The next cursor is read before the write, so it never
    passes a record that came in between, and saved after it: a failed pull is
    pulled again. The overlap makes repeats normal.
    """
    spec = store.spec
    published = parse_publication(F.col(spec.event_time))
    undated = records.where(published.isNull()).count()
    pages, more = 0, True
    while more:
        since = store.cursor()
        fresh = cursor.newer_than(records, published, since)
        if limit is None:
            moved, more = cursor.next_cursor(fresh, published, since).first()[0], False
        else:
            ahead = cursor.advance(records, published, since, limit=limit)
            more = ahead.more
            fresh = fresh.orderBy(published, position).limit(limit)
            end = cursor.next_cursor(fresh, published, since)
            moved = ahead.cursor if more else end.first()[0]
        keyed = with_producer_key(fresh, spec, position)
        kept = keep_last(keyed, "producer_key", position)
        body = envelope(kept.select(*spec.schema.names), spec, fetched_at)
        write_messages(kept.select(body.alias("value")), landing, file_format)
        store.save_cursor(moved)
        pages += 1
    return Pull(moved, pages, undated)


def migrate_legacy(store: Store, legacy: DataFrame) -> int:
    """Put a legacy table under bronze, and what silver lacks of it into silver.

    ``legacy`` holds typed silver rows with their insert time; keys may be missing
    or repeated. Rows without any identifier stay in bronze only. Both parts are
    complete at once or not at all: after a failure it starts over, and running it
    again changes nothing. Returns the number of the batch.
    """
    spec, ledger = store.spec, store.ledger()
    for seq in ledger.unmerged():
        merge_batch(store, seq, ledger=ledger)
    seq = ledger.landed(MIGRATION, 0)
    if seq is not None:
        return seq
    seq = 0 if (last := ledger.last("bronze")) is None else last + 1
    keyed = backfill_key(legacy, spec)
    names = [f.name for f in spec.bronze_schema]
    store.put(backfill_bronze(keyed, spec).select(*names), "bronze", seq)
    known = keyed.where(F.col(spec.key).isNotNull())
    stored = store.stored_for(known.select(spec.key).distinct(), before=seq, ledger=ledger)
    added = backfilled(stored, known, spec).transform(with_digest, spec)
    columns = [f.name for f in spec.silver_schema] + [DIGEST]
    store.put(added.select(*columns), "silver/changes", seq)
    store.commit(("bronze", seq, MIGRATION, 0), ("silver", seq), ledger=ledger)
    return seq


def reprocess(store: Store) -> None:
    """Silver and its history again, from the messages in bronze.

    Rows of a migration are taken from its change set, in their place in the order:
    bronze does not hold all they had. The rebuilt state is a full copy as of the
    last batch, so the change sets under it are read no more; the snapshot holds
    every state a batch made. Run it while nothing else uses the store.
    """
    spec, ledger = store.spec, store.ledger()
    upto = ledger.last("bronze")
    if upto is None:
        return
    moved = F.col(SEQ).isin(ledger.migrations())
    bronze = store.bronze().where(~moved)
    times = bronze.groupBy(SEQ).agg(F.max(INGESTED).alias("_at"))
    typed = silver_rows(bronze.select(F.col(RAW).alias("value"), SEQ), spec, [SEQ])
    stamped = typed.join(times, SEQ)
    legacy = store.changes(None, upto).where(moved).withColumn("_at", F.col(spec.updated_at))
    stamped = stamped.unionByName(legacy.select(*stamped.columns))
    states = replay_history(stamped, spec, SEQ, F.col("_at")).drop("_at")
    path = scratch_path(store.spark, "reprocessed")
    states.write.parquet(path)
    states = store.spark.read.parquet(path)
    is_open = F.col(VALID_TO).isNull()
    current = states.where(is_open).drop(VALID_FROM, VALID_TO)
    store.copy(current, upto, current.count(), ledger)
    late = ledger.unmerged()
    if late:
        store.commit(*(("silver", seq) for seq in late), ledger=ledger)
    ends = states.where(~is_open).withColumn("_end", F.col(VALID_TO).cast("timestamp_ntz"))
    closed = store.opened(ends.drop(VALID_FROM, VALID_TO)).withColumn(VALID_TO, F.col("_end"))
    store.replace_snapshot(closed.drop("_end"), upto)


def take_snapshot(store: Store) -> None:
    """Close the versions of the keys that changed since the last snapshot.

    Reads the change sets since then, and the rows that their keys had before:
    neither the whole of silver nor the history.
    """
    spec, ledger = store.spec, store.ledger()
    upto, since = ledger.last("silver"), ledger.last("snapshot")
    if upto is None or upto == since:
        return
    first = since is None
    changed = store.newest_changes(since, upto, ledger).select(spec.key, spec.updated_at)
    names = [f.name for f in spec.silver_schema]
    before = store.stored_for(changed.select(spec.key), 0 if first else since + 1, names, ledger)
    store.put(history.closed_versions(before, changed, spec), "snapshot", upto)
    store.commit(("snapshot", upto), ledger=ledger)


def build_gold(store: Store, dims_from: str = "silver") -> None:
    """Rebuild the star in full, beside the one in use.

    Dimensions come from current silver; with ``dims_from="history"`` an old
    version also finds attribute values that have since disappeared, and the fact
    needs no join at all.
    """
    spec, ledger = store.spec, store.ledger()
    build = (ledger.last("gold") or 0) + 1
    snapshot = store.snapshot()
    source = store.silver() if dims_from == "silver" else snapshot
    # Written once: the dimensions read these columns, not silver.
    path = store.gold_path(build, "_staged")
    star.staging_view(source, spec).write.mode("overwrite").parquet(path)
    staged = store.spark.read.parquet(path)
    seen = ledger.last("snapshot") == ledger.last("silver")
    if dims_from == "silver" and seen and star.fact_columns(spec) <= {*staged.columns}:
        # So are the open versions, which are silver as the last snapshot saw it.
        snapshot = store.snapshot(staged)
    tables = star.dimensions(staged, spec)
    tables[spec.fact.date_dim] = calendar.dim_date(store.spark)

    observed: list[tuple[str, str | None, int]] = []

    def write(name: str) -> None:
        observed.extend(_observed_write(tables[name], store.gold_path(build, name), name, spec))

    # Independent jobs: together they fill the cluster better than in a row.
    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(write, tables))
    members = None
    if dims_from == "silver":
        members = {
            dim.name: store.spark.read.parquet(store.gold_path(build, dim.name))
            for dim in spec.fact.dims
        }
    tables[spec.fact.name] = star.fact(snapshot, members, spec)
    write(spec.fact.name)
    counted = store.spark.createDataFrame(observed, quality.OBSERVED)
    counted.coalesce(1).write.mode("overwrite").parquet(store.gold_path(build, "_observed"))
    store.commit(("gold", build))


def _observed_write(
    df: DataFrame, path: str, name: str, spec: FeedSpec
) -> list[tuple[str, str | None, int]]:
    """Write a table, and count its rows and nulls as they are written."""
    columns = quality.not_null_columns(spec)[name]
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns)]
    df.observe(seen, *counts).write.mode("overwrite").parquet(path)
    found = dict(seen.get)
    return [(name, None, found["rows"]), *((name, c, found[c]) for c in columns)]


def test_results(store: Store) -> DataFrame:
    return quality.run_tests(store.silver(), store.gold(), store.spec, store.observed())


def run_tests(store: Store) -> None:
    failing = test_results(store).where("failures > 0").collect()
    if failing:
        named = ", ".join(f"{r.test} {r.table_name}.{r.column_name}" for r in failing)
        raise TestsFailed(named)
