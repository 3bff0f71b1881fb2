"""One query per operator, over the feed of :mod:`checks.feed`."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import feed
from noticehouse.feeds.recall_notice import BRAND, DISTRIBUTOR, PRODUCT, RISK
from noticehouse.feeds.recall_notice import RECALL_NOTICE as SPEC
from noticehouse.functions import dates, keys, payload
from noticehouse.operators import (
    audit,
    bronze,
    calendar,
    clean,
    cursor,
    dedup,
    deltas,
    drift,
    history,
    merge,
    quality,
    rebuild,
    reports,
    star,
)
from noticehouse.operators.numbering import numbered
from noticehouse.session import apply_runtime_conf, scratch_path
from noticehouse.plans import maintain
from noticehouse.plans.build import take_snapshot
from noticehouse.plans.warehouse_run import Run, row_counts, run_warehouse
from noticehouse.sources import messages as msg
from noticehouse.sources.store import Store
from noticehouse.streaming import ingest, keyed_state

BATCH = ("batch_no",)
SNAPSHOT_AFTER = (2, 4, 6)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return plain(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def plain(df: DataFrame) -> DataFrame:
    """Times and dates as text, which reads the same in every client."""
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    typed = [f.name for f in df.schema if isinstance(f.dataType, moments)]
    return df.withColumns({c: F.col(c).cast("string") for c in typed}) if typed else df


def stamp(batch: int | str = "batch_no") -> Column:
    """Time of a batch: a day each."""
    return F.expr(f"timestamp'2024-01-01 00:00:00' + make_dt_interval({batch})")


# --- layers the gold queries read, written once per session and input ---------


def _as_of(states: DataFrame, batch: int) -> DataFrame:
    """Of all states of all keys, those that stood after a batch."""
    at = stamp(batch)
    return (
        states.where((F.col(rebuild.VALID_FROM) <= at))
        .where(F.col(rebuild.VALID_TO).isNull() | (F.col(rebuild.VALID_TO) > at))
        .drop(rebuild.VALID_FROM, rebuild.VALID_TO, merge.DIGEST)
    )


@dataclass
class Layers:
    spark: SparkSession
    sf_dir: str
    root: str
    written: set[str] = field(default_factory=set)

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/{name}"
        if name not in self.written:
            build().write.mode("overwrite").parquet(path, compression="zstd")
            self.written.add(name)
        return self.spark.read.parquet(path)

    def history(self) -> DataFrame:
        columns = [*SPEC.silver_columns, SPEC.key, merge.DIGEST, SPEC.updated_at, SPEC.inserted_at]
        return self.table("history", lambda: self._replayed(columns))

    def _replayed(self, columns: Sequence[str]) -> DataFrame:
        messages = feed.messages(self.spark, self.sf_dir, dealt=True)
        return rebuild.replay_columns(
            messages, SPEC, "batch_no", stamp(), columns, dealt=[feed.DEAL]
        )

    def silver(self, batch: int = feed.REPLAY) -> DataFrame:
        """Current state as it stood after a batch."""
        return _as_of(self.history(), batch)

    def staged_history(self) -> DataFrame:
        """The history in the columns that gold reads: a third of its bytes. Where the
        whole history is written, they are read from it."""
        if "history" in self.written:
            return self.history().select(*SPEC.staging_columns, rebuild.VALID_FROM, rebuild.VALID_TO)
        return self.table("staged_history", lambda: self._replayed(SPEC.staging_columns))

    def snapshot(self) -> DataFrame:
        return self.table("snapshot", lambda: snapshots(self))

    def staged(self, batch: int = feed.REPLAY) -> DataFrame:
        return star.staging_view(_as_of(self.staged_history(), batch), SPEC)

    def dim(self, dim) -> DataFrame:
        return self.table(dim.name, lambda: star.dimension(self.staged(), dim))

    def dims(self) -> dict[str, DataFrame]:
        return {dim.name: self.dim(dim) for dim in SPEC.fact.dims}

    def dates(self) -> DataFrame:
        return self.table("dim_date", lambda: calendar.dim_date(self.spark))

    def fact(self) -> DataFrame:
        return self.table(
            "fact", lambda: star.fact(self.snapshot(), self.dims(), SPEC)
        )

    def build(self) -> None:
        """Write every layer, so that a query read afterwards costs its own work."""
        self.gold()

    def gold(self) -> dict[str, DataFrame]:
        return {
            **self.dims(),
            SPEC.fact.date_dim: self.dates(),
            SPEC.fact.name: self.fact(),
        }


_LAYERS: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYERS:
        _LAYERS[key] = Layers(spark, sf_dir, scratch_path(spark, "layers"))
    return _LAYERS[key]


def rows(spark: SparkSession, sf_dir: str, batches: range | None = None) -> DataFrame:
    return clean.silver_rows(feed.messages(spark, sf_dir, batches), SPEC, BATCH)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices as records in arrival order, the replayed batch last."""
    notices = feed.records(spark, sf_dir).where("kind = 'notice'")
    position = F.col("batch_no") * feed.POSITIONS + F.col("o_orderkey")
    return notices.withColumn("position", position)


# --- sources, parse, scalar functions -----------------------------------------


@query
def bronze_append(spark, sf_dir):
    batch_id = bronze.batch_stamp("run", F.col("batch_no"))
    return bronze.bronze_rows(feed.messages(spark, sf_dir), SPEC, batch_id).drop(
        bronze.INGESTED
    )


@query
def bronze_batch_stamp(spark, sf_dir):
    batch_id = bronze.batch_stamp("run", F.col("batch_no"))
    stamped = bronze.bronze_rows(
        feed.messages(spark, sf_dir), SPEC, batch_id, stamp(), keep=BATCH
    )
    return stamped.groupBy(bronze.BATCH).agg(
        F.count("*").alias("messages"),
        F.min(bronze.INGESTED).alias("first_ingested"),
        F.max(bronze.INGESTED).alias("last_ingested"),
    )


@query
def produce_envelope(spark, sf_dir):
    notices = records(spark, sf_dir)
    array = F.from_json("identification_produits", "array<string>")
    fields = notices.withColumn("identification_produits", array)
    body = msg.envelope(
        fields.select(*feed.FIELDS), SPEC, stamp(1)
    )
    return fields.select("position", body.alias("value"))


@query
def parse_messages(spark, sf_dir):
    parsed = clean.parse_messages(feed.messages(spark, sf_dir), SPEC, BATCH)
    return parsed.withColumn(
        "identification_produits", F.array_join("identification_produits", "|")
    )


@query
def payload_drift(spark, sf_dir):
    """All fields of the messages with their kinds, and how they stand to a schema that
    lacks one field and has declared another as a number."""
    changed = [
        T.StructField(f.name, T.IntegerType()) if f.name == "libelle" else f
        for f in SPEC.schema
        if f.name != "motif_rappel"
    ]
    feed_spec = replace(SPEC, schema=T.StructType(changed))
    return drift.payload_fields(feed.messages(spark, sf_dir), feed_spec, BATCH)


@query
def normalize_text(spark, sf_dir):
    parsed = clean.parse_messages(feed.messages(spark, sf_dir), SPEC, BATCH)
    return clean.normalize_text(parsed, SPEC).select(
        "id", *BATCH, *SPEC.text_fields, *SPEC.verbatim_fields
    )


@query
def cast_dates(spark, sf_dir):
    parsed = clean.parse_messages(feed.messages(spark, sf_dir), SPEC, BATCH)
    typed = [*SPEC.timestamp_fields, *map(SPEC.silver_name, SPEC.date_fields)]
    return clean.cast_dates(parsed, SPEC).select("id", *BATCH, *typed)


@query
def array_to_json(spark, sf_dir):
    parsed = clean.parse_messages(feed.messages(spark, sf_dir), SPEC, BATCH)
    return clean.arrays_to_json(parsed, SPEC).select("id", *BATCH, *SPEC.array_fields)


@query
def clean_messages(spark, sf_dir):
    return clean.clean_messages(feed.messages(spark, sf_dir), SPEC, BATCH)


@query
def silver_projection(spark, sf_dir):
    cleaned = clean.clean_messages(feed.messages(spark, sf_dir), SPEC, BATCH)
    return clean.to_silver_columns(cleaned, SPEC, BATCH)


@query
def dedup_key(spark, sf_dir):
    return rows(spark, sf_dir).select(SPEC.key, SPEC.api_id, *SPEC.key_fields, *BATCH)


@query
def producer_key(spark, sf_dir):
    keyed = records(spark, sf_dir).withColumn(
        "rappel_guid", F.when(F.col("o_orderkey") % 12 == 0, "").otherwise(F.col("rappel_guid"))
    )
    return clean.with_producer_key(keyed, SPEC, "position").select("position", "producer_key")


@query
def parse_publication(spark, sf_dir):
    notices = feed.records(spark, sf_dir).where("kind = 'notice'")
    return notices.select(
        "id", *BATCH, F.expr(feed.PUBLICATION_TEXT).alias("text")
    ).withColumn("published", dates.parse_publication(F.col("text")))


# --- dedup, upsert, backfill ---------------------------------------------------


@query
def latest_versions(spark, sf_dir):
    return dedup.latest_versions(rows(spark, sf_dir), SPEC)


@query
def dedup_keep_last(spark, sf_dir):
    keyed = clean.with_producer_key(records(spark, sf_dir), SPEC, "position")
    kept = dedup.keep_last(keyed, "producer_key", "position")
    return kept.select(
        "producer_key", "position", "first_position", "id", "numero_version", "libelle"
    )


EARLY, LATE = range(0, 3), range(3, feed.BATCHES)


def _stored_and_incoming(spark, sf_dir):
    """State after the first batches, and the newest rows of all others."""
    early = rows(spark, sf_dir, EARLY)
    stored = rebuild.rebuild_silver(early, SPEC, "batch_no", stamp())
    incoming = dedup.latest_versions(rows(spark, sf_dir, LATE), SPEC)
    return stored, incoming.drop(*BATCH)


@query
def silver_upsert(spark, sf_dir):
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    changes = merge.upsert_changes(stored, incoming, SPEC, stamp(3))
    return merge.overlay(stored, changes, SPEC).drop(merge.DIGEST)


@query
def content_changed(spark, sf_dir):
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    same_key = F.col(f"s.{SPEC.key}") == F.col(f"i.{SPEC.key}")
    return (
        stored.alias("s")
        .join(incoming.alias("i"), same_key)
        .select(f"s.{SPEC.key}", merge.content_changed(SPEC).alias("changed"))
    )


@query
def upsert_outcomes(spark, sf_dir):
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    return merge.upsert_outcomes(stored, incoming, SPEC).select(SPEC.key, "outcome")


@query
def rebuild_silver(spark, sf_dir):
    rebuilt = rebuild.rebuild_silver(rows(spark, sf_dir), SPEC, "batch_no", stamp())
    return rebuilt.drop(merge.DIGEST)


def _legacy(spark, sf_dir):
    """A legacy table: typed rows, keys partly missing, duplicates, insert time."""
    return rows(spark, sf_dir).withColumns(
        {
            "db_id": F.col("batch_no") * feed.POSITIONS + F.col("api_id"),
            SPEC.inserted_at: stamp(),
            SPEC.key: F.when(F.col("api_id") % 4 != 0, F.col(SPEC.key)),
        }
    )


@query
def backfill_key(spark, sf_dir):
    filled = dedup.backfill_key(_legacy(spark, sf_dir), SPEC)
    return filled.select("db_id", SPEC.key)


@query
def distinct_on_cleanup(spark, sf_dir):
    kept = dedup.drop_duplicate_keys(_legacy(spark, sf_dir), SPEC, "db_id")
    return kept.select("db_id", SPEC.key, SPEC.version)


@query
def backfill_bronze(spark, sf_dir):
    legacy = _legacy(spark, sf_dir).withColumn(
        SPEC.payload, F.when(F.col("db_id") % 7 != 0, F.col(SPEC.payload))
    )
    return merge.backfill_bronze(legacy, SPEC)


@query
def backfill_silver(spark, sf_dir):
    early = rows(spark, sf_dir, EARLY)
    stored = rebuild.rebuild_silver(early, SPEC, "batch_no", stamp())
    legacy = dedup.backfill_key(_legacy(spark, sf_dir), SPEC)
    return merge.backfill_silver(stored, legacy, SPEC)


# --- history --------------------------------------------------------------------


def snapshots(built: Layers) -> DataFrame:
    """The snapshot of the staged columns, taken after three of the batches.

    A row that stood at the last snapshot is in it with the same stamp, so it does
    nothing: only what changed since then meets the history.
    """
    first, *later = SNAPSHOT_AFTER
    taken = history.open_versions(
        history.snapshot_source(built.staged(first), SPEC), SPEC
    )
    for last, batch in zip(SNAPSHOT_AFTER, later):
        changed = built.staged(batch).where(F.col(SPEC.updated_at) > stamp(last))
        taken = history.take_snapshot(taken, history.snapshot_source(changed, SPEC), SPEC)
    return taken


_VERSIONED: dict[tuple[str, str], Store] = {}


def versioned(spark: SparkSession, sf_dir: str) -> Store:
    """A store with a change set per batch, copies on the way, and snapshots and
    maintained counts after three batches."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _VERSIONED:
        return _VERSIONED[key]
    store = Store(spark, scratch_path(spark, "versioned"), SPEC, compact_every=3)
    states = layers(spark, sf_dir).history()
    columns = [f.name for f in SPEC.silver_schema] + [merge.DIGEST]
    for batch in range(feed.BATCHES):
        made = states.where(F.col(rebuild.VALID_FROM) == stamp(batch))
        store.put(made.select(*columns), "silver/changes", batch)
        store.commit(("bronze", batch, "versioned", batch), ("silver", batch))
        store.compact_if_due(batch)
        if batch in SNAPSHOT_AFTER:
            take_snapshot(store)
            maintain.update_counts(store)
    _VERSIONED[key] = store
    return store


@query
def scd2_snapshot(spark, sf_dir):
    """Closed and open versions, as the store's snapshots left them."""
    return versioned(spark, sf_dir).snapshot()


@query
def maintained_counts(spark, sf_dir):
    """Current notices per member, from the signed rows of all change sets."""
    store = versioned(spark, sf_dir)
    parts = [
        deltas.per_value(maintain.counts(store, dim.name), dim, dim.label).select(
            F.lit(dim.name).alias("dimension"), F.col(dim.label).alias("label"), deltas.ROWS
        )
        for dim in SPEC.fact.dims
    ]
    return quality.union_all(parts)


@query
def insertion_ids(spark, sf_dir):
    silver = layers(spark, sf_dir).silver()
    rows = silver.select(SPEC.key, SPEC.inserted_at)
    return numbered(rows, [SPEC.inserted_at, SPEC.key]).select("id", SPEC.key)


@query
def scd2_intervals(spark, sf_dir):
    snapshot = layers(spark, sf_dir).snapshot()
    return snapshot.select(SPEC.key, SPEC.version, *history.interval_columns())


@query
def replay_messages(spark, sf_dir):
    return msg.replay(layers(spark, sf_dir).silver(), SPEC).select("value")


# --- star schema ------------------------------------------------------------------


@query
def staging_view(spark, sf_dir):
    return star.staging_view(layers(spark, sf_dir).silver(), SPEC, "stg_silver")


@query
def surrogate_key(spark, sf_dir):
    staged = layers(spark, sf_dir).staged()
    return staged.select(
        SPEC.key, keys.surrogate_key(*map(F.col, PRODUCT.columns)).alias("surrogate_key")
    )


@query
def unknown_member(spark, sf_dir):
    staged = layers(spark, sf_dir).staged()
    counted = staged.agg(
        *(F.count_if(F.col(d.required).isNull()).alias(d.name) for d in SPEC.fact.dims)
    )
    parts = [
        counted.select(
            F.lit(d.name).alias("dimension"),
            keys.unknown_key(d.name).alias("member_key"),
            F.lit(keys.UNKNOWN_LABEL).alias("label"),
            F.col(d.name).alias("notices"),
        )
        for d in SPEC.fact.dims
    ]
    return quality.union_all(parts)


def _dimension(dim):
    def build(spark, sf_dir):
        return star.dimension(layers(spark, sf_dir).staged(), dim)

    return build


for _name, _dim in {
    "dim_product": PRODUCT,
    "dim_brand": BRAND,
    "dim_risk": RISK,
    "dim_distributor": DISTRIBUTOR,
}.items():
    _build = _dimension(_dim)
    _build.__name__ = _name
    query(_build)


def _per_day(spark, sf_dir):
    day = dates.date_key(F.col(SPEC.event_time)).alias("date_key")
    staged = layers(spark, sf_dir).staged()
    return staged.groupBy(day).agg(F.count("*").alias("notices"))


@query
def date_spine(spark, sf_dir):
    spine = calendar.date_spine(spark).withColumn("date_key", dates.date_key(F.col("date_day")))
    return (
        spine.join(_per_day(spark, sf_dir), "date_key", "left")
        .select("date_day", F.coalesce("notices", F.lit(0)).alias("notices"))
    )


@query
def dim_date(spark, sf_dir):
    counted = calendar.dim_date(spark).join(_per_day(spark, sf_dir), "date_key", "left")
    return counted.withColumn("notices", F.coalesce("notices", F.lit(0)))


def _looked_up(spark, sf_dir):
    built = layers(spark, sf_dir)
    found = built.snapshot()
    for dim in SPEC.fact.dims:
        found = star.lookup(found, built.dim(dim), dim)
    return found


@query
def null_safe_join(spark, sf_dir):
    dim_keys = [dim.key for dim in SPEC.fact.dims]
    return _looked_up(spark, sf_dir).select(SPEC.key, rebuild.VALID_FROM, *dim_keys)


@query
def fk_unknown_fallback(spark, sf_dir):
    dim_keys = [star.with_fallback(dim) for dim in SPEC.fact.dims]
    return _looked_up(spark, sf_dir).select(SPEC.key, rebuild.VALID_FROM, *dim_keys)


@query
def array_length(spark, sf_dir):
    snapshot = layers(spark, sf_dir).snapshot()
    items, name = SPEC.fact.array_count
    return snapshot.select(
        SPEC.key, rebuild.VALID_FROM, payload.array_length(F.col(items)).alias(name)
    )


@query
def duration_days(spark, sf_dir):
    snapshot = layers(spark, sf_dir).snapshot()
    end, name = SPEC.fact.duration
    length = dates.days_between(F.col(end), F.col(SPEC.event_time))
    return snapshot.select(SPEC.key, rebuild.VALID_FROM, length.alias(name))


@query
def date_key(spark, sf_dir):
    return rows(spark, sf_dir).select(
        SPEC.api_id, *BATCH, dates.date_key(F.col(SPEC.event_time)).alias("date_key")
    )


@query
def fact_recall(spark, sf_dir):
    built = layers(spark, sf_dir)
    return star.fact(built.snapshot(), built.dims(), SPEC)


# --- reports ------------------------------------------------------------------------


@query
def report_by_category(spark, sf_dir):
    built = layers(spark, sf_dir)
    return reports.current_by_category(
        built.fact(), built.dim(PRODUCT), PRODUCT, "categorie_produit"
    )


@query
def report_monthly(spark, sf_dir):
    built = layers(spark, sf_dir)
    return reports.current_by_month(built.fact(), built.dates())


@query
def report_top_distributors(spark, sf_dir):
    built = layers(spark, sf_dir)
    return reports.top_members(built.fact(), built.dim(DISTRIBUTOR), DISTRIBUTOR)


@query
def report_total(spark, sf_dir):
    return reports.total_current(layers(spark, sf_dir).fact())


@query
def layer_counts(spark, sf_dir):
    built = layers(spark, sf_dir)
    return reports.layer_counts(
        {
            "bronze": feed.messages(spark, sf_dir),
            "silver": built.silver(),
            "gold": built.fact(),
        }
    )


@query
def recent_notices(spark, sf_dir):
    columns = [
        "numero_fiche",
        "numero_version",
        "date_publication",
        "categorie_produit",
        "marque_produit",
        "libelle",
    ]
    return reports.recent_notices(layers(spark, sf_dir).silver(), SPEC, columns)


@query
def history_browse(spark, sf_dir):
    built = layers(spark, sf_dir)
    columns = [
        "numero_fiche",
        "numero_version",
        "nom_produit",
        "marque_produit",
        "valid_from",
        "valid_to",
        "is_current",
    ]
    return reports.history_browse(
        built.fact(), built.dims(), (PRODUCT, BRAND), columns, SPEC.key
    )


# --- incremental cursor: the events table as the source ---------------------------


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@query
def next_cursor(spark, sf_dir):
    notices = feed.records(spark, sf_dir).where("kind = 'notice'")
    published = dates.parse_publication(F.col("date_publication"))
    return cursor.next_cursor(notices, published, cursor.DEFAULT_CURSOR)


@query
def incremental_filter(spark, sf_dir):
    return cursor.incremental(_events(spark, sf_dir), F.col("ts"), "2024-01-03")


@query
def cursor_advance(spark, sf_dir):
    """Every page of a capped pull, from the first cursor to the end."""
    pages = cursor.pages(
        _events(spark, sf_dir), F.col("ts"), cursor.DEFAULT_CURSOR, limit=5_000
    )
    return spark.createDataFrame(
        pages, "cursor string, pulled bigint, status string, next_cursor string"
    )


# --- data tests and audit ------------------------------------------------------------


@query
def test_not_null(spark, sf_dir):
    gold = layers(spark, sf_dir).gold()
    return quality.union_all(
        [
            quality.null_counts(gold[table], table, columns)
            for table, columns in quality.not_null_columns(SPEC).items()
        ]
    )


@query
def test_unique(spark, sf_dir):
    gold = layers(spark, sf_dir).gold()
    on_tables = [
        quality.duplicate_counts(gold[table], table, column)
        for table, column in quality.unique_columns(SPEC).items()
    ]
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.union_all(
        [*on_tables, quality.duplicate_counts(lineitem, "lineitem", "l_orderkey")]
    )


@query
def test_relationships(spark, sf_dir):
    gold = layers(spark, sf_dir).gold()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    tables = {
        "lineitem": spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
        "closed_orders": orders.where("o_orderstatus <> 'P'"),
    }
    rule = quality.Relationship("lineitem", "l_orderkey", "closed_orders", "o_orderkey")
    on_fact = quality.orphan_counts(gold, quality.relationships(SPEC))
    return on_fact.unionByName(quality.orphan_counts(tables, [rule]))


@query
def test_silver_key(spark, sf_dir):
    silver = layers(spark, sf_dir).silver()
    return quality.duplicate_counts(silver, "silver", SPEC.key)


@query
def audit_counts(spark, sf_dir):
    """Rows per layer of a store, before and after its gold is built."""
    counted = [
        (moment, layer, n)
        for moment, found in warehouse(spark, sf_dir, "dated").counts.items()
        for layer, n in found.items()
    ]
    return spark.createDataFrame(counted, "moment string, layer string, row_count bigint")


def _steps(spark, sf_dir):
    """Events as a step log: a user is a run, an event one of its steps."""
    state = F.expr(
        "case event_type when 'error' then case when value < 1 then 'failed' else 'success' end"
        " when 'view' then case when value < 1 then 'skipped' else 'success' end"
        " else 'success' end"
    )
    return _events(spark, sf_dir).select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("dag_run_id"),
        F.col("event_id").alias("task_id"),
        "ts",
        state.alias("state"),
    )


@query
def run_status(spark, sf_dir):
    return audit.run_status(_steps(spark, sf_dir), "dag_run_id", F.col("task_id") % 10 == 0)


def _audit(spark, sf_dir):
    steps = _steps(spark, sf_dir)
    runs = steps.groupBy("dag_run_id").agg(
        F.min("ts").alias("started_at"),
        F.max("ts").alias("last_at"),
        F.count("*").alias("steps"),
        audit.status_of(F.col("state")).alias("status"),
    )
    counts = {
        "bronze": F.col("steps"),
        "silver": F.col("steps") - 1,
        "gold": F.when(F.col("status") == audit.SUCCESS, F.col("steps")),
    }
    return audit.audit_rows(runs, F.col("last_at"), counts)


def _audit_table(spark, sf_dir):
    """The audit rows as a store keeps them, appended in two parts."""
    store, made = Store(spark, scratch_path(spark, "audited"), SPEC), _audit(spark, sf_dir)
    store.add_audit(made.where("status = 'success'"))
    store.add_audit(made.where("status <> 'success'"))
    return store.audit()


@query
def audit_log(spark, sf_dir):
    return _audit_table(spark, sf_dir)


@query
def recent_runs(spark, sf_dir):
    return reports.recent_runs(_audit_table(spark, sf_dir))


# --- streams: three deliveries to a landing folder, one run after each ------------


DELIVERIES = (range(0, 3), range(3, 6), range(6, 7))


def _deliver(spark, sf_dir, landing: str, batches: range, file_format="parquet") -> None:
    delivered = feed.messages(spark, sf_dir, batches)
    # A message is some 1.3 KB of text, of which nine tenths are field names and repeats.
    options = {"compression": "gzip"} if file_format == "text" else {}
    msg.write_messages(delivered, landing, file_format, **options)


@query
def stream_source(spark, sf_dir):
    """Messages that went through a landing folder and the stream source."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "landed")
    for batches in DELIVERIES:
        _deliver(spark, sf_dir, landing, batches, "text")
    (
        msg.landing_stream(spark, landing)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.parquet(out)


def _streamed(spark, sf_dir, step: Callable) -> Store:
    store = Store(spark, scratch_path(spark, "streamed"), SPEC, compact_every=2)
    landing = store.path("landing")
    for number, batches in enumerate(DELIVERIES):
        _deliver(spark, sf_dir, landing, batches)
        step(store, msg.landing_stream(spark, landing, "parquet"), number)
    return store


@query
def stream_available_now(spark, sf_dir):
    """What each run took: a run resumes where the last one stopped."""

    def run(store, messages, number):
        ingest.start_ingest(store, messages, clock=stamp).awaitTermination()

    store = _streamed(spark, sf_dir, run)
    return store.bronze().groupBy(bronze.BATCH).agg(F.count("*").alias("messages"))


@query
def stream_to_silver(spark, sf_dir):
    def run(store, messages, number):
        ingest.ingest_available(store, messages, clock=stamp)

    return _streamed(spark, sf_dir, run).silver()


@query
def stream_keyed_state(spark, sf_dir):
    """Silver from the changes that keyed stream state lets through, over three runs."""
    landing, folder = scratch_path(spark, "landing"), scratch_path(spark, "keyed")
    for number, batches in enumerate(DELIVERIES):
        _deliver(spark, sf_dir, landing, batches)
        source = msg.landing_stream(spark, landing, "parquet")
        keyed_state.start_keyed_ingest(source, SPEC, folder, stamp(number)).awaitTermination()
    return keyed_state.current(spark, folder, SPEC)


@dataclass
class Warehouse:
    """A store after whole runs, and its rows per layer at some moments."""

    store: Store
    runs: dict[str, Run]
    counts: dict[str, dict[str, int | None]] = field(default_factory=dict)


def _every(spark, sf_dir) -> Warehouse:
    """All messages, whose undated notices fail a data test."""
    runs = {}

    def run(store, messages, number):
        run_id = f"all-{number}"
        runs[run_id] = run_warehouse(
            store, messages, run_id, clock=stamp, raise_on_failure=False
        )

    return Warehouse(_streamed(spark, sf_dir, run), runs)


def _dated(spark, sf_dir) -> Warehouse:
    """Dated notices only."""
    store = Store(spark, scratch_path(spark, "dated"), SPEC)
    landing = store.path("landing")
    notices = feed.messages(spark, sf_dir).where("seq % 29 <> 0 and value like '{%'")
    msg.write_messages(notices, landing, "parquet")
    source = msg.landing_stream(spark, landing, "parquet")
    ingest.ingest_available(store, source, clock=stamp)
    before = row_counts(store)
    runs = {"dated-0": run_warehouse(store, source, "dated-0", clock=stamp)}
    return Warehouse(store, runs, {"before": before, "after": row_counts(store)})


WAREHOUSES = {"every": _every, "dated": _dated}
_RAN: dict[tuple[str, str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str, name: str) -> Warehouse:
    """One of the stores, run once: a query that reads one does not wait for the other."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _RAN:
        _RAN[key] = WAREHOUSES[name](spark, sf_dir)
    return _RAN[key]


def warehouses(spark: SparkSession, sf_dir: str) -> list[Warehouse]:
    return [warehouse(spark, sf_dir, name) for name in WAREHOUSES]


@query
def warehouse_run(spark, sf_dir):
    """Each step of three runs that fail a data test, and of one that does not, with
    the run's audit row."""
    ran = warehouses(spark, sf_dir)
    steps = [
        (run_id, step, state, str(made.failure) if state == audit.FAILED else None)
        for one in ran
        for run_id, made in one.runs.items()
        for step, state in made.states.items()
    ]
    logged = quality.union_all([one.store.audit() for one in ran])
    logged = logged.withColumnRenamed("dag_run_id", "run_id").select(
        "run_id", "status", *(f"{layer}_row_count" for layer in audit.LAYERS)
    )
    table = spark.createDataFrame(steps, "run_id string, step string, state string, failure string")
    return table.join(logged, "run_id")


@query
def warehouse_fact(spark, sf_dir):
    """The fact after three whole runs."""
    return warehouse(spark, sf_dir, "every").store.gold()[SPEC.fact.name]
