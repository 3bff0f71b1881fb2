"""The warehouse on a shared folder of Parquet tables.

Bronze and the silver change sets are append-only folders, one per batch. The
current state is the last full copy of silver (``base``) without the keys that
changed since, plus the newest change of those. So a batch writes what it
changed and never rewrites silver. A full copy is made once the changes since
the last one weigh enough against it, so copying costs a constant share of the
rows written, whatever the size of silver.

A copy is cut into hash buckets of the key, as many as its rows ask for, and the
ledger keeps their number with the copy. Inside a bucket rows are sorted by key, in
small row groups with a Bloom filter of their keys, so a batch reads the row groups
of its keys only.

History is kept in two parts: closed versions are appended by each snapshot, and the
open ones are silver as the last snapshot saw it. So a snapshot reads the change sets
since the last one and the earlier rows of their keys, and closes those.

The ledger numbers batches in the order they were landed, whichever stream they
come from, and remembers stream and batch. Readers look no further than what it
marks complete: a batch that did not finish is written over, and one that did is
never written again. Entries that belong together appear at once, in one file; the
files are folded into one from time to time. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticehouse.operators import history
from noticehouse.operators.clean import RAW
from noticehouse.operators.cursor import DEFAULT_CURSOR
from noticehouse.operators.dedup import top_row
from noticehouse.operators.merge import DIGEST, merge_columns
from noticehouse.session import empty
from noticehouse.spec import FeedSpec

SEQ = "seq"
# Hash bucket of a full copy of silver.
BUCKET = "bucket"
# Up to so many keys are named in a scan; of more, only the buckets are.
KEYS = 1000
# A legacy table that was moved in: silver has its rows, bronze not all of them.
MIGRATION = "backfill"

LEDGER = (
    T.StructType()
    .add("layer", "string")
    .add(SEQ, "long")
    .add("stream", "string")
    .add("batch", "long")
    .add("buckets", "long")
)
# Names of the audit's columns.
STEPS = T.StructType().add("dag_run_id", "string").add("task_id", "string").add("state", "string")
# Marks a fold of the ledger as whole; its number is the entries it holds.
FOLD = "fold"

AUDIT_SCHEMA = (
    T.StructType()
    .add("dag_run_id", "string")
    .add("started_at", "timestamp")
    .add("ended_at", "timestamp")
    .add("duration_seconds", "double")
    .add("status", "string")
    .add("bronze_row_count", "long")
    .add("silver_row_count", "long")
    .add("gold_row_count", "long")
    .add("details", "string")
)


class Ledger:
    """What is complete, as one read of the entries saw it. One entry per batch and
    layer, so it is small beside a single batch."""

    def __init__(self, rows: Iterable[T.Row]):
        rows = list(rows)
        folds = {r.generation for r in rows if r.layer == FOLD}
        self.generation = max(folds, default=0)
        live = [r for r in rows if r.generation == self.generation]
        folded = sum(r[SEQ] for r in live if r.layer == FOLD)
        self.entries = [tuple(r[f.name] for f in LEDGER) for r in live if r.layer != FOLD]
        #: Entries in files of their own.
        self.loose = len(self.entries) - folded

    def add(self, entries: Sequence[tuple]) -> None:
        self.entries += entries
        self.loose += len(entries)

    def numbers(self, layer: str) -> list[int]:
        return sorted({e[1] for e in self.entries if e[0] == layer})

    def merged(self, after: int | None, upto: int) -> list[int]:
        """The change sets after one batch and up to another."""
        return [n for n in self.numbers("silver") if (after is None or n > after) and n <= upto]

    def last(self, layer: str, upto: int | None = None) -> int | None:
        """Number of the newest complete batch of a layer."""
        numbers = self.numbers(layer)
        return max((n for n in numbers if upto is None or n <= upto), default=None)

    def landed(self, stream: str, batch: int) -> int | None:
        """The number under which a batch of a stream was landed, if it was."""
        return max(
            (e[1] for e in self.entries if e[0] == "bronze" and e[2:4] == (stream, batch)), default=None
        )

    def migrations(self) -> list[int]:
        return sorted(e[1] for e in self.entries if e[0] == "bronze" and e[2] == MIGRATION)

    def unmerged(self) -> list[int]:
        """Landed batches that silver does not have yet, in order. More than one is
        left only by a failure between landing and merging."""
        merged = self.last("silver")
        return [n for n in self.numbers("bronze") if merged is None or n > merged]

    def buckets(self, copy: int) -> int:
        return max(e[4] for e in self.entries if e[:2] == ("base", copy))


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    spec: FeedSpec
    compact_every: int = 16
    compact_share: float = 0.1
    #: Rows of a copy's bucket, which one task sorts as wide rows, and of a row group in it.
    bucket_rows: int = 1 << 17
    group_rows: int = 1 << 14
    fold_every: int = 64

    def within(self, spark: SparkSession) -> Store:
        return replace(self, spark=spark)

    def path(self, *parts: object) -> str:
        return "/".join([self.root.rstrip("/"), *map(str, parts)])

    def batch_path(self, layer: str, seq: int) -> str:
        return self.path(layer, f"{SEQ}={seq}")

    def checkpoint(self, stream: int) -> str:
        return self.path("checkpoints", f"stream={stream}")

    # --- reading and writing -------------------------------------------------

    def _find(self, path: str, schema: T.StructType) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        found = self._find(path, schema)
        return empty(self.spark, schema) if found is None else found

    def batches(self, layer: str, schema: T.StructType) -> DataFrame:
        return self._read(self.path(layer), T.StructType([*schema]).add(SEQ, "long"))

    def put(self, df: DataFrame, layer: str, seq: int) -> None:
        """Write a batch's folder, replacing what an earlier attempt left. Message
        texts are all different, so no dictionary is tried for them."""
        plain = {f"parquet.enable.dictionary#{c}": False for c in (RAW, self.spec.payload)}
        df.write.mode("overwrite").options(**plain).parquet(self.batch_path(layer, seq))

    def commit(
        self,
        *entries: tuple,
        ledger: Ledger | None = None,
    ) -> None:
        """Mark batches complete: ``(layer, seq[, stream, batch[, buckets]])`` each.
        All appear together, in one file."""
        ledger = ledger or self.ledger()
        whole = [(*e, *[None] * (len(LEDGER) - len(e))) for e in entries]
        self._write_entries(whole, ledger.generation)
        ledger.add(whole)
        if ledger.loose >= self.fold_every:
            self._fold(ledger)

    def _write_entries(self, entries: Sequence[tuple], generation: int) -> None:
        rows = self.spark.createDataFrame(list(entries), LEDGER).coalesce(1)
        rows.write.mode("append").parquet(self.path("ledger", f"generation={generation}"))

    def _fold(self, ledger: Ledger) -> None:
        """All entries in one file, which the reader takes once it is there."""
        mark = (FOLD, len(ledger.entries), None, None, None)
        self._write_entries([*ledger.entries, mark], ledger.generation + 1)
        self._remove(self.path("ledger", f"generation={ledger.generation}"))
        ledger.generation, ledger.loose = ledger.generation + 1, 0

    def ledger(self) -> Ledger:
        schema = T.StructType([*LEDGER]).add("generation", "integer")
        return Ledger(self._read(self.path("ledger"), schema).collect())

    def last(self, layer: str, upto: int | None = None) -> int | None:
        return self.ledger().last(layer, upto)

    # --- layers ----------------------------------------------------------------

    def bronze(self) -> DataFrame:
        """All messages of the batches that landed."""
        last = self.last("bronze")
        batches = self.batches("bronze", self.spec.bronze_schema)
        return batches.where(F.col(SEQ) <= (-1 if last is None else last))

    def bronze_batch(self, seq: int) -> DataFrame:
        """One landed batch, without listing the others."""
        return self._read(self.batch_path("bronze", seq), self.spec.bronze_schema)

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.spec.silver_schema]).add(DIGEST, T.BinaryType())

    def changes(self, after: int | None, upto: int) -> DataFrame:
        """Rows written by the batches after one and up to another."""
        sets = self.batches("silver/changes", self._stored).where(F.col(SEQ) <= upto)
        return sets if after is None else sets.where(F.col(SEQ) > after)

    def newest_changes(self, after: int | None, upto: int, ledger: Ledger | None = None) -> DataFrame:
        ledger = ledger or self.ledger()
        return self._newest(self.changes(after, upto), len(ledger.merged(after, upto)))

    def _newest(self, rows: DataFrame, sets: int) -> DataFrame:
        """Newest row per key of so many sets, each of which holds a key once: the rows
        of a single set need not meet."""
        if sets > 1:
            rows = top_row(rows, [self.spec.key], [F.col(SEQ).desc()])
        return rows.drop(SEQ)

    def _base(self, seq: int) -> DataFrame:
        schema = T.StructType([*self._stored]).add(BUCKET, "integer")
        return self._read(self.batch_path("silver/base", seq), schema)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.spec.key), F.lit(buckets)).cast("int")

    def silver_stored(self, before: int | None = None, ledger: Ledger | None = None) -> DataFrame:
        """Current state with content digests, as it was before a batch."""
        ledger = ledger or self.ledger()
        upto = ledger.last("silver") if before is None else before - 1
        if upto is None or upto < 0:
            return empty(self.spark, self._stored)
        base = ledger.last("base", upto)
        if base is None:
            return self.newest_changes(None, upto, ledger)
        newest = self.newest_changes(base, upto, ledger)
        copy = self._base(base).drop(BUCKET)
        untouched = copy.join(newest.select(self.spec.key), self.spec.key, "left_anti")
        return untouched.select(*self._stored.names).unionByName(newest)

    def stored_for(
        self,
        keys: DataFrame,
        before: int,
        columns: Sequence[str] | None = None,
        ledger: Ledger | None = None,
    ) -> DataFrame:
        """Some columns of the stored rows of some keys, as they were before a batch;
        else those that a merge needs.

        Reads each change set once, and of the copy the buckets of these keys, of
        few keys only their row groups; all is cut to the keys before anything is
        compared.
        """
        ledger = ledger or self.ledger()
        key, columns = self.spec.key, [*(columns or merge_columns(self.spec))]
        if before <= 0:
            return empty(self.spark, self._stored).select(*columns)
        base = ledger.last("base", before - 1)
        sets = self.changes(base, before - 1).select(*columns, SEQ)
        if base is not None:
            copy = self._base(base).where(self._holds(keys, ledger.buckets(base)))
            sets = sets.unionByName(copy.select(*columns, F.lit(base).alias(SEQ)))
        mine = sets.join(keys, key, "left_semi")
        return self._newest(mine, len(ledger.merged(base, before - 1)) + (base is not None))

    def _holds(self, keys: DataFrame, buckets: int) -> Column:
        """Where a copy may hold some keys."""
        key = self.spec.key
        few = keys.select(key, self._bucket(buckets).alias(BUCKET)).limit(KEYS + 1).collect()
        if len(few) <= KEYS:
            names = [r[key] for r in few]
            return F.col(BUCKET).isin(sorted({r[BUCKET] for r in few})) & F.col(key).isin(names)
        # At most as many as the copy has folders.
        found = keys.select(self._bucket(buckets).alias(BUCKET)).distinct().collect()
        return F.col(BUCKET).isin(sorted(r[BUCKET] for r in found))

    def silver(self) -> DataFrame:
        return self.silver_stored().drop(DIGEST)

    def compact(self, seq: int, ledger: Ledger | None = None) -> None:
        """Make a full copy of silver as of a batch. The last copy and the changes since
        move once, to the buckets, where the newest row of each key is taken."""
        ledger = ledger or self.ledger()
        base = ledger.last("base", seq)
        rows = self.changes(base, seq)
        if base is not None:
            copied = self._base(base).select(*self._stored.names, F.lit(base).cast("long").alias(SEQ))
            rows = rows.unionByName(copied)
        self.copy(rows, seq, rows.count(), ledger)

    def copy(self, state: DataFrame, seq: int, rows: int, ledger: Ledger | None = None) -> None:
        """Store the whole state as of a batch, of about so many rows, by buckets of
        the key: a task each, sorted, with Bloom filters of the keys. Of rows with the
        number of their batch, the newest of each key are the state."""
        key, buckets = self.spec.key, max(1, -(-rows // self.bucket_rows))
        state = state.withColumn(BUCKET, self._bucket(buckets)).repartition(buckets, BUCKET)
        if SEQ in state.columns:
            state = top_row(state, [BUCKET, key], [F.col(SEQ).desc()])
        filtered = {
            f"parquet.enable.dictionary#{self.spec.payload}": False,
            f"parquet.bloom.filter.enabled#{key}": True,
            f"parquet.bloom.filter.expected.ndv#{key}": self.group_rows,
            f"parquet.bloom.filter.fpp#{key}": 0.0001,
            "parquet.block.row.count.limit": self.group_rows,
        }
        (
            state.select(*self._stored.names, BUCKET)
            .sortWithinPartitions(BUCKET, key)
            .write.mode("overwrite")
            .options(**filtered)
            .partitionBy(BUCKET)
            .parquet(self.batch_path("silver/base", seq))
        )
        self.commit(("base", seq, None, None, buckets), ledger=ledger)

    def compact_if_due(self, seq: int, ledger: Ledger | None = None) -> None:
        """Copy after some batches, when they hold a share of the last copy's
        rows. Row counts come from the files' footers."""
        ledger = ledger or self.ledger()
        base = ledger.last("base")
        fresh = [n for n in ledger.numbers("silver") if base is None or n > base]
        if len(fresh) < self.compact_every:
            return
        if base is not None:
            copied = self._base(base).count()
            if self.changes(base, seq).count() < self.compact_share * copied:
                return
        self.compact(seq, ledger)

    # --- history -------------------------------------------------------------------

    def snapshot(self, silver: DataFrame | None = None) -> DataFrame:
        """SCD2 history: closed versions as they were written, and the open ones,
        which are silver as of the last snapshot. No row meets another.

        ``silver`` may hold that state in some columns, which are then the history's."""
        ledger = self.ledger()
        upto = ledger.last("snapshot")
        if silver is None:
            silver = self.silver_stored((-1 if upto is None else upto) + 1, ledger)
        opened = self.opened(silver)
        closed = self.batches("snapshot", opened.schema)
        closed = closed.where(F.col(SEQ) <= (-1 if upto is None else upto)).drop(SEQ)
        return closed.unionByName(opened)

    def opened(self, silver: DataFrame) -> DataFrame:
        source = history.snapshot_source(silver.drop(DIGEST), self.spec)
        return history.open_versions(source, self.spec)

    def replace_snapshot(self, closed: DataFrame, upto: int) -> None:
        """Store the closed versions of all batches up to one, in place of those before."""
        ledger = self.ledger()
        self.put(closed, "snapshot", upto)
        for number in ledger.numbers("snapshot"):
            if number < upto:
                self._remove(self.batch_path("snapshot", number))
        self.commit(("snapshot", upto), ledger=ledger)

    def gold(self) -> dict[str, DataFrame] | None:
        """The gold tables of the newest complete build."""
        build = self.last("gold")
        if build is None:
            return None
        fact = self.spec.fact
        names = [*(dim.name for dim in fact.dims), fact.date_dim, fact.name]
        return {n: self.spark.read.parquet(self.gold_path(build, n)) for n in names}

    def observed(self) -> DataFrame | None:
        """Rows and nulls of the newest gold tables, counted as they were written."""
        build = self.last("gold")
        return None if build is None else self.spark.read.parquet(self.gold_path(build, "_observed"))

    def gold_path(self, build: int, table: str) -> str:
        return self.path("gold", f"build={build}", table)

    def _remove(self, path: str) -> None:
        """Delete a folder wherever the store lies."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsc.hadoopConfiguration()
        place.getFileSystem(conf).delete(place, True)

    def retain(self, builds: int = 2, copies: int = 2) -> None:
        """Delete gold builds and copies of silver but the newest ones, and the copy
        that the last snapshot reads.

        Keep enough builds for the queries that may still read one.
        """
        ledger = self.ledger()
        seen = ledger.last("snapshot")
        # The open versions are read from the copy under the last snapshot.
        under = None if seen is None else ledger.last("base", seen)
        gone = {layer: set(ledger.numbers(f"gone-{layer}")) for layer in ("gold", "base")}
        entries = []
        for layer, most, path in (
            ("gold", builds, lambda n: self.path("gold", f"build={n}")),
            ("base", copies, lambda n: self.batch_path("silver/base", n)),
        ):
            for number in ledger.numbers(layer)[: -max(most, 1)]:
                if number in gone[layer] or (layer == "base" and number == under):
                    continue
                self._remove(path(number))
                entries.append((f"gone-{layer}", number))
        if entries:
            self.commit(*entries, ledger=ledger)

    def audit(self) -> DataFrame:
        return self._read(self.path("audit"), AUDIT_SCHEMA)

    def add_audit(self, rows: DataFrame) -> None:
        typed = [F.col(f.name).cast(f.dataType) for f in AUDIT_SCHEMA]
        rows.select(*typed).write.mode("append").parquet(self.path("audit"))

    # --- steps of runs ---

    def add_step(self, run_id: str, step: str, state: str) -> None:
        row = self.spark.createDataFrame([(run_id, step, state)], STEPS).coalesce(1)
        row.withColumn("at", F.current_timestamp()).write.mode("append").parquet(self.path("steps"))

    def steps(self) -> DataFrame:
        return self._read(self.path("steps"), T.StructType([*STEPS]).add("at", "timestamp"))

    def steps_done(self, run_id: str) -> set[str]:
        """Steps that a run, in any of its attempts, has behind it."""
        mine = self.steps().where((F.col("dag_run_id") == run_id) & (F.col("state") == "success"))
        return {r[0] for r in mine.select("task_id").distinct().collect()}

    # --- ingest cursor ------------------------------------------------------------

    def _cursors(self) -> DataFrame:
        schema = T.StructType().add(SEQ, "long").add("cursor", "string")
        return self._read(self.path("cursor"), schema)

    def cursor(self) -> str:
        return self._cursors().agg(F.max_by("cursor", SEQ)).first()[0] or DEFAULT_CURSOR

    def save_cursor(self, value: str) -> None:
        number = (self._cursors().agg(F.max(SEQ)).first()[0] or 0) + 1
        entry = self.spark.range(number, number + 1, 1, 1).toDF(SEQ)
        entry.withColumn("cursor", F.lit(value)).write.mode("append").parquet(self.path("cursor"))

    # --- SQL ------------------------------------------------------------------------

    def register_views(self, layers: Iterable[str] = ("bronze", "silver", "gold")) -> None:
        """Temporary views for SQL users, named after the tables."""
        # The names SQL users know the layers by.
        if "bronze" in layers:
            self.bronze().createOrReplaceTempView("bronze_events")
        if "silver" in layers:
            self.silver().createOrReplaceTempView("silver_current")
        if "gold" in layers:
            for name, df in (self.gold() or {}).items():
                df.createOrReplaceTempView(name)
            self.snapshot().createOrReplaceTempView("snapshot")
            self.audit().createOrReplaceTempView("audit_pipeline_runs")
