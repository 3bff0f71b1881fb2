"""The store: order of batches, repeats, buckets, retention, migration, reprocessing."""

import json

import pytest
from pyspark.sql import functions as F

from noticehouse.operators import clean, cursor, history, merge
from noticehouse.operators.rebuild import VALID_FROM
from noticehouse.plans import build
from noticehouse.sources.store import BUCKET, SEQ, Store
from noticehouse.streaming import ingest
from tests.test_history import source  # noqa: F401
from tests.test_merge import BATCHES, expected, fold, notices, stamp, summary


@pytest.fixture
def store(spark, spec, tmp_path):
    return Store(spark, str(tmp_path / "warehouse"), spec, compact_every=2)


def notice(id, version=1, text="a"):
    return {"id": id, "numero_version": version, "libelle": text}


def versions(store):
    return {r.api_id: r.numero_version for r in store.silver().collect()}


def test_a_lower_stream_number_loses_nothing(store, messages):
    """Streams 0, 1, 0: batches count in the order they land."""
    for stream, batch, payload in (
        ("stream0", 0, notice(1, 1)),
        ("stream1", 0, notice(1, 2)),
        ("stream0", 1, notice(1, 5)),
    ):
        ingest.ingest_batch(store, messages(payload, notice(10 + batch)), stream, batch, stamp)
        build.take_snapshot(store)
    assert versions(store) == {1: 5, 10: 1, 11: 1}
    found = store.snapshot().where("api_id = 1").select("numero_version", "dbt_valid_to").collect()
    assert sorted(r[0] for r in found) == [1, 2, 5]
    assert [r[0] for r in found if r[1] is None] == [5]


def test_a_repeated_batch_changes_nothing(store, messages):
    """Also after a copy of silver, and with the wall clock."""
    batches = [messages(notice(1), notice(2)), messages(notice(1, 2), notice(3)), messages(notice(4))]

    def tables():
        found = (store.silver_stored(), store.changes(None, 9), store.snapshot(), store.bronze())
        return [sorted(map(str, df.collect())) for df in found]

    for k, batch in enumerate(batches):
        ingest.ingest_batch(store, batch, "s", k, ingest.wall_clock)
    store.compact(2)
    build.take_snapshot(store)
    before = tables()
    for k, batch in enumerate(batches):
        ingest.ingest_batch(store, batch, "s", k, ingest.wall_clock)
    build.take_snapshot(store)
    assert tables() == before


def test_an_unfinished_landing_is_not_read_and_is_written_over(store, messages):
    ingest.ingest_batch(store, messages(notice(1)), "s", 0, stamp)
    torn = store.bronze().drop(SEQ)
    store.put(torn.unionByName(torn), "bronze", 1)
    assert store.bronze().count() == 1
    ingest.ingest_batch(store, messages(notice(2)), "other", 0, stamp)
    assert store.bronze().count() == 2 and versions(store) == {1: 1, 2: 1}


def test_a_landed_batch_left_behind_is_merged_first(store, messages):
    ingest.ingest_batch(store, messages(notice(1)), "s", 0, stamp)
    ingest.land_batch(store, messages(notice(1, 3), notice(2, 3)), "s", 1, stamp)
    ingest.ingest_batch(store, messages(notice(1, 2)), "t", 0, stamp)
    assert versions(store) == {1: 3, 2: 3}


@pytest.fixture
def grown(store, messages):
    """A copy of many keys, and two change sets after it."""
    ingest.ingest_batch(store, messages(*(notice(k) for k in range(300))), "s", 0, stamp)
    ingest.ingest_batch(store, messages(notice(7, 2)), "s", 1, stamp)
    assert store.last("base") == 1
    store = Store(store.spark, store.root, store.spec, compact_every=99)
    ingest.ingest_batch(store, messages(notice(8, 2)), "s", 2, stamp)
    ingest.ingest_batch(store, messages(notice(9, 2)), "s", 3, stamp)
    return store


def scanned(df):
    """Rows that the scans of a finished plan gave, by what they read."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_a_merge_reads_the_row_groups_of_its_keys(spark, spec, tmp_path, messages):
    """A hundred keys of forty thousand read a small share of a copy."""
    store = Store(spark, str(tmp_path / "large"), spec, bucket_rows=5000, group_rows=100)
    state = spark.range(40_000).select(
        *(F.col("id").cast("string").alias(f.name) if f.name == spec.key else F.lit(None).cast(f.dataType).alias(f.name)
          for f in store._stored)
    )
    store.commit(("silver", 0))
    store.copy(state, 0, 40_000)
    assert store.ledger().buckets(0) == 8
    keys = spark.range(0, 40_000, 400).select(F.col("id").cast("string").alias(spec.key))
    found = store.stored_for(keys, before=1)
    assert set(found.columns) == set(merge.merge_columns(spec))
    assert sorted(r[spec.key] for r in found.collect()) == sorted(str(k) for k in range(0, 40_000, 400))
    # At most a row group per key, and few more by a false positive.
    assert scanned(found) <= 100 * 100 + 2000
    many = spark.range(0, 40_000, 20).select(F.col("id").cast("string").alias(spec.key))
    assert store.stored_for(many, before=1).count() == 2000


def test_a_copy_is_written_by_tasks_in_proportion_to_rows(store, messages, spark):
    for rows, buckets in ((300, 3), (1000, 10)):
        grown = Store(spark, f"{store.root}-{rows}", store.spec, bucket_rows=100)
        ingest.ingest_batch(grown, messages(*(notice(k) for k in range(rows))), "s", 0, stamp)
        grown.compact(0)
        ledger = grown.ledger()
        assert ledger.buckets(0) == buckets
        copy = grown._base(0)
        assert copy.select(BUCKET).distinct().count() == buckets
        assert grown.silver().count() == rows


def test_a_batch_reads_the_ledger_once_and_it_is_folded(spark, spec, tmp_path, messages, monkeypatch):
    store = Store(spark, str(tmp_path / "folded"), spec, fold_every=6)
    reads = []
    plain = Store.ledger
    monkeypatch.setattr(Store, "ledger", lambda self: reads.append(1) or plain(self))
    for k in range(8):
        ingest.ingest_batch(store, messages(notice(k), notice(1, k + 2)), "s", k, stamp)
    assert len(reads) == 8
    ledger = store.ledger()
    assert ledger.generation >= 2 and ledger.numbers("silver") == list(range(8))
    assert ledger.loose < 6 and ledger.landed("s", 5) == 5
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(store.path("ledger"))
    assert files.where("path like '%.parquet'").count() <= 7
    assert versions(store)[1] == 9


def test_an_unfinished_fold_is_not_read(store, messages):
    ingest.ingest_batch(store, messages(notice(1)), "s", 0, stamp)
    store._write_entries([("bronze", 7, "x", 1, None)], 1)
    assert store.ledger().numbers("bronze") == [0]


def test_stored_rows_of_a_merge_are_those_of_silver(grown, spark):
    keys = grown.silver().select(grown.spec.key).where("api_id % 3 = 0 or api_id in (7, 8)")
    assert grown.ledger().buckets(1) == 1
    mine = grown.stored_for(keys, before=4).select(grown.spec.key, merge.DIGEST, "numero_version")
    whole = grown.silver_stored().join(keys, grown.spec.key).select(*mine.columns)
    assert sorted(mine.collect(), key=str) == sorted(whole.collect(), key=str)


def test_retention_spares_what_is_in_use(store, messages):
    for k in range(4):
        ingest.ingest_batch(store, messages(notice(k), notice(1, k + 2)), "s", k, stamp)
        build.take_snapshot(store)
        store.compact(k)
        build.build_gold(store)
    live, silver = store.gold(), versions(store)
    store.retain(builds=2, copies=1)
    store.retain(builds=2, copies=1)
    assert live["fact_rappel"].count() == store.gold()["fact_rappel"].count() > 0
    assert versions(store) == silver
    assert store.spark.read.parquet(store.gold_path(3, "dim_produit")).count() > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.spark.read.parquet(store.gold_path(2, "dim_produit"))


def test_reprocessing_gives_what_the_stream_gave(store, messages, spec):
    rows = notices(4, per_batch=30)
    for batch in range(BATCHES):
        texts = (json.dumps(r) for b, r in rows if b == batch)
        ingest.ingest_batch(store, messages(*map(json.loads, texts)), "s", batch, stamp)
        build.take_snapshot(store)
    want, taken = expected(fold(rows)[0]), store.snapshot()

    def spans(df):
        return sorted(map(str, df.select(spec.key, "numero_version", VALID_FROM, "dbt_valid_to").collect()))

    before = spans(taken)
    assert summary(store.silver(), spec) == want
    build.reprocess(store)
    assert summary(store.silver(), spec) == want
    assert spans(store.snapshot()) == before
    late = messages({"id": 77, "rappel_guid": "late", "numero_version": 1})
    ingest.ingest_batch(store, late, "s", BATCHES, stamp)
    assert store.silver().count() == len(want) + 1


def legacy_rows(messages, spec, *payloads):
    typed = clean.silver_rows(messages(*payloads), spec)
    return typed.withColumn(spec.inserted_at, stamp(0))


def test_legacy_rows_move_into_the_store(store, messages, spec):
    ingest.ingest_batch(store, messages(notice(1, 5)), "s", 0, stamp)
    legacy = legacy_rows(messages, spec, notice(1, 9), notice(2, 1, "old"), notice(2, 2, "new"), notice(3))
    without = F.when(F.col("api_id") != 3, F.col(spec.key))
    number = build.migrate_legacy(store, legacy.withColumn(spec.key, without))
    assert versions(store) == {1: 5, 2: 2, 3: 1}
    assert store.bronze().where("_batch_id = 'backfill_dev'").count() == 4
    assert build.migrate_legacy(store, legacy) == number
    assert store.bronze().count() == 5
    ingest.ingest_batch(store, messages(notice(2, 3), notice(3, 1, "changed")), "s", 1, stamp)
    assert versions(store) == {1: 5, 2: 3, 3: 1}
    (changed,) = store.silver().where("api_id = 3").collect()
    assert changed.libelle == "changed"


class Broken(Exception):
    pass


def failing(monkeypatch, name, at):
    """A store method that fails at its n-th call."""
    plain, calls = getattr(Store, name), []

    def method(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == at:
            raise Broken
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(Store, name, method)


def legacy_without_payload(messages, spec):
    rows = legacy_rows(messages, spec, notice(1, 9), notice(2, 1, "old"), notice(3), notice(4, 2, "four"))
    return rows.withColumn(spec.payload, F.when(F.col("api_id") > 2, F.col(spec.payload)))


def tables(store):
    names = [f.name for f in store.spec.silver_schema]
    return (
        sorted(map(str, store.silver().select(names).collect())),
        sorted(map(str, store.bronze().drop("_ingested_at").collect())),
        sorted(map(str, store.snapshot().collect())),
    )


@pytest.mark.parametrize("name,at", [("put", 1), ("put", 2), ("commit", 1), ("_write_entries", 1)])
def test_a_failed_migration_loses_no_row(spark, spec, tmp_path, messages, monkeypatch, name, at):
    def run(root, broken):
        store = Store(spark, str(tmp_path / root), spec)
        ingest.ingest_batch(store, messages(notice(1, 5)), "s", 0, stamp)
        legacy = legacy_without_payload(messages, spec)
        if broken:
            with monkeypatch.context() as patch:
                failing(patch, name, at)
                with pytest.raises(Broken):
                    build.migrate_legacy(store, legacy)
            assert versions(store) == {1: 5} and store.bronze().count() == 1
        build.migrate_legacy(store, legacy)
        assert build.migrate_legacy(store, legacy) == 1
        ingest.ingest_batch(store, messages(notice(3, 2)), "s", 1, stamp)
        build.take_snapshot(store)
        return tables(store)

    assert run("broken", True) == run("clean", False)


def test_a_batch_between_a_failed_migration_and_its_repeat(store, messages, spec, monkeypatch):
    legacy = legacy_without_payload(messages, spec)
    with monkeypatch.context() as patch:
        failing(patch, "commit", 1)
        with pytest.raises(Broken):
            build.migrate_legacy(store, legacy)
    ingest.ingest_batch(store, messages(notice(4, 7)), "s", 0, stamp)
    assert versions(store) == {4: 7}
    build.migrate_legacy(store, legacy)
    assert versions(store) == {1: 9, 2: 1, 3: 1, 4: 7}


def test_reprocessing_keeps_legacy_rows(store, messages, spec):
    """Rows without a payload, their stamps, and what came before and after them."""
    ingest.ingest_batch(store, messages(notice(1, 5)), "s", 0, stamp)
    build.take_snapshot(store)
    build.migrate_legacy(store, legacy_without_payload(messages, spec))
    build.take_snapshot(store)
    ingest.ingest_batch(store, messages(notice(3, 2, "new"), notice(9)), "s", 1, lambda _: stamp(5))
    build.take_snapshot(store)
    before = tables(store)
    assert versions(store) == {1: 5, 2: 1, 3: 2, 4: 2, 9: 1}
    assert store.snapshot().where("dbt_valid_to is not null").count() == 1
    build.reprocess(store)
    assert tables(store) == before
    build.reprocess(store)
    assert tables(store) == before


def test_a_snapshot_reads_changes_only(spark, spec, tmp_path, messages):
    """Rows read by a snapshot do not grow with silver or with the history."""
    store = Store(spark, str(tmp_path / "history"), spec, compact_every=99, bucket_rows=200, group_rows=50)
    ingest.ingest_batch(store, messages(*(notice(k) for k in range(2000))), "s", 0, lambda _: stamp(0))
    store.compact(0)
    build.take_snapshot(store)
    for k in range(1, 4):
        ingest.ingest_batch(store, messages(notice(7, k + 1), notice(2000 + k)), "s", k, lambda _, k=k: stamp(k))
        ledger = store.ledger()
        changed = store.newest_changes(k - 1, k).select(spec.key, spec.updated_at)
        names = [f.name for f in spec.silver_schema]
        before = store.stored_for(changed.select(spec.key), k, names, ledger)
        assert scanned(before) <= 4 * 50 + 2 * k
        build.take_snapshot(store)
    taken = store.snapshot()
    rows = taken.where("api_id = 7").orderBy(VALID_FROM).collect()
    assert [r.numero_version for r in rows] == [1, 2, 3, 4]
    assert [r.dbt_valid_to for r in rows] == [r.dbt_valid_from for r in rows[1:]] + [None]
    assert taken.count() == 2000 + 3 + 3
    store.retain(copies=1)
    assert store.snapshot().count() == 2006


def test_a_backfill_doubles_no_key(spark, messages, spec):
    stored = legacy_rows(messages, spec, notice(9)).withColumn(spec.updated_at, stamp(0))
    legacy = legacy_rows(messages, spec, notice(1), notice(1, 2), notice(2), notice(9, 7))
    found = merge.backfill_silver(stored, legacy, spec).collect()
    assert sorted((r.api_id, r.numero_version) for r in found) == [(1, 2), (2, 1), (9, 1)]


def test_a_stored_row_without_a_digest_counts_as_different(messages, spec):
    stored = legacy_rows(messages, spec, notice(1)).withColumn(merge.DIGEST, F.lit(None).cast("binary"))
    incoming = clean.silver_rows(messages(notice(1, 1, "changed")), spec)
    (row,) = merge.upsert_outcomes(stored, incoming, spec).select("outcome").collect()
    assert row.outcome == "updated_content"


def records(spark, spec, days):
    rows = [(i, f"g{i}", d and f"2026-01-{d:02d}") for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id int, rappel_guid string, date_publication string")
    missing = [f for f in spec.schema if f.name not in df.columns]
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return df.withColumn("position", F.col("id"))


def test_a_capped_pull_goes_on_to_the_end(store, spark, spec):
    landing = store.path("landing")
    pulled = build.pull_records(
        store, records(spark, spec, [*range(1, 21), None]), "position", landing, limit=8
    )
    assert (pulled.cursor, pulled.pages, pulled.undated) == ("2026-01-19", 3, 1)
    landed = [json.loads(r.value)["id"] for r in spark.read.text(landing).collect()]
    assert set(landed) == set(range(20))
    assert store.cursor() == "2026-01-19"


def test_a_stuck_pull_is_an_error(store, spark, spec):
    with pytest.raises(cursor.CursorStuck):
        build.pull_records(store, records(spark, spec, [5] * 9), "position", store.path("l"), limit=4)


def test_snapshots_add_the_same_work_each(source, spec):  # noqa: F811
    """Chained snapshots read the history and the source once each."""
    taken = history.open_versions(source(a=1, b=1), spec)
    counts = []
    for day in (2, 3, 4):
        taken = history.take_snapshot(taken, source(a=day, c=day), spec)
        plan = taken._jdf.queryExecution().optimizedPlan().toString()
        counts.append(plan.count("FullOuter"))
    # b stays as it is; a and c open and close a row each time.
    assert counts == [1, 2, 3] and taken.count() == 1 + 4 + 3
