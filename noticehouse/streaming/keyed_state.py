"""The upsert as keyed stream state: change sets without reading silver.

A key's version, content digest and first stamp are all that a merge must know of
it. Here they are the stream's state (RocksDB, which spills to disk and is
checkpointed with the offsets), and the output is the rows that change silver, once
each. State grows with the number of keys, not with their rows; the number of
shuffle partitions is fixed with the checkpoint's first run, so choose it for the
keys to come.

Only what decides, and the payload, pass through Python; a row's other columns are
parsed again from the payload of the rows that win. Keys are dealt over buckets, whose
state is one map from key to what is known: it crosses to Python and back once per
bucket and micro-batch, where a state per key would cost round trips for each. In
return a micro-batch rewrites the states of its buckets, not of its keys alone.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from noticehouse.operators.clean import silver_rows
from noticehouse.operators.dedup import top_row
from noticehouse.operators.merge import DIGEST, with_digest
from noticehouse.spec import FeedSpec

#: How often a key has changed: orders a key's changes.
CHANGE = "_change"
_BUCKET, _DECIDED = "_bucket", "_decided"
#: Groups that keys are dealt over, fixed with the checkpoint's first run. A task holds
#: one group at a time: its states, and its newest rows of the micro-batch.
BUCKETS = 1 << 12


def keyed_changes(messages: DataFrame, spec: FeedSpec, now: Column | None = None) -> DataFrame:
    """Silver rows that each micro-batch inserts or rewrites, with their ``CHANGE``.

    Messages that are null, broken or without an identifier give no row, as in a
    batch merge; ties of version, time and id go to the larger payload. Only the
    newest row per key and Arrow batch is shuffled, so a hot key meets its state as
    few rows, which are passed over one by one.
    """
    now = F.current_timestamp() if now is None else now
    rows = silver_rows(messages, spec).transform(with_digest, spec).withColumn(spec.updated_at, now)
    rows = rows.select(spec.key, *_order(spec), DIGEST, spec.updated_at)
    moments = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
    # Instants pass through Python as numbers, which no worker's time zone touches.
    plain = rows.withColumns({c: F.unix_micros(c) for c in moments})
    newest = plain.mapInArrow(_newest_in_batch(spec), plain.schema)
    dealt = newest.withColumn(_BUCKET, F.pmod(F.xxhash64(spec.key), F.lit(BUCKETS)).cast("int"))
    shape = T.StructType([plain.schema[c] for c in (spec.payload, DIGEST, spec.updated_at)])
    shape = shape.add(spec.inserted_at, T.LongType()).add(CHANGE, T.LongType())
    known = T.StructType([plain.schema[spec.version], plain.schema[DIGEST]])
    known = known.add("first", T.LongType()).add("changes", T.LongType())
    states = T.StructType().add("states", T.MapType(plain.schema[spec.key].dataType, known))
    found = dealt.groupBy(_BUCKET).transformWithState(
        _newest_version(spec, states), shape, "Append", "None"
    )
    instants = {c: F.timestamp_micros(c) for c in (spec.updated_at, spec.inserted_at)}
    decided = F.struct(DIGEST, spec.updated_at, spec.inserted_at, CHANGE).alias(_DECIDED)
    won = found.withColumns(instants).select(F.col(spec.payload).alias("value"), decided)
    whole = silver_rows(won, spec, [_DECIDED]).select("*", f"{_DECIDED}.*")
    return whole.select(*spec.silver_schema.names, DIGEST, CHANGE)


# What runs in workers is made inside functions, so that it travels with the query
# and workers need not have this package.


def _order(spec: FeedSpec) -> list[str]:
    return [spec.version, spec.event_time, spec.api_id, spec.payload]


def _newest_in_batch(spec: FeedSpec):
    key, by = spec.key, _order(spec)

    def newest(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if not batch.num_rows:
                continue
            order = [(key, "ascending"), *((c, "descending") for c in by)]
            batch = batch.take(pc.sort_indices(batch, sort_keys=order, null_placement="at_end"))
            keys = batch.column(key)
            starts = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
            yield batch.filter(pa.concat_arrays([pa.array([True]), starts]))

    return newest


def _newest_version(spec: FeedSpec, states: T.StructType):
    name, version, digest, by = spec.key, spec.version, DIGEST, _order(spec)
    payload, stamp = spec.payload, spec.updated_at
    row_of = Row(payload, digest, stamp, spec.inserted_at, CHANGE)

    class NewestVersion(StatefulProcessor):
        """The rule of an upsert, for the newest row of each key of a bucket."""

        def init(self, handle) -> None:
            self._known = handle.getValueState("known", states)

        def handleInputRows(self, key, rows, timerValues):
            newest = {}
            for row in rows:
                rank = [(row[c] is not None, row[c]) for c in by]
                met = newest.get(row[name])
                if met is None or rank > met[0]:
                    newest[row[name]] = rank, row
            (held,) = self._known.get() or ({},)
            known = {k: tuple(v) for k, v in held.items()}
            won = []
            for found, (_, row) in newest.items():
                first, changes, wins = row[stamp], 0, True
                if found in known:
                    old, content, first, changes = known[found]
                    new = row[version]
                    if old is not None:
                        same = new == old and bytes(row[digest]) == bytes(content)
                        wins = new is not None and new >= old and not same
                if wins:
                    changes += 1
                    known[found] = row[version], bytes(row[digest]), first, changes
                    won.append(row_of(row[payload], row[digest], row[stamp], first, changes))
            if won:
                self._known.update((known,))
            yield from won

        def close(self) -> None:
            pass

    return NewestVersion()


def start_keyed_ingest(
    messages: DataFrame, spec: FeedSpec, folder: str, now: Column | None = None
) -> StreamingQuery:
    """Append the changes of what the source holds to ``folder``/changes, then stop.

    State, offsets and the sink's log are under ``folder`` too: a run that was cut
    short is taken up again, and no change is written twice.
    """
    return (
        keyed_changes(messages, spec, now)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/changes")
    )


def current(spark: SparkSession, folder: str, spec: FeedSpec) -> DataFrame:
    """Silver: each key's last change."""
    changes = spark.read.parquet(f"{folder}/changes")
    return top_row(changes, [spec.key], [F.col(CHANGE).desc()]).select(*spec.silver_schema.names)
