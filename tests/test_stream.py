"""Streams, the layer store and whole runs."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from noticehouse.operators import clean, merge, quality, rebuild
from noticehouse.plans import build, warehouse_run
from noticehouse.plans.warehouse_run import run_warehouse
from noticehouse.sources import messages as msg
from noticehouse.sources.store import SEQ, Store
from noticehouse.streaming import ingest
from tests.test_merge import BATCHES, expected, fold, notices, stamp, summary


@pytest.fixture
def store(spark, spec, tmp_path):
    return Store(spark, str(tmp_path / "warehouse"), spec, compact_every=2)


@pytest.fixture
def land(spark, store):
    def put(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
        msg.write_messages(df, store.path("landing"), "parquet")

    return put


def source(store, **options):
    return msg.landing_stream(store.spark, store.path("landing"), "parquet", **options)


def payload(id, version=1, text="a", **more):
    return json.dumps({"id": id, "numero_version": version, "libelle": text, **more})


def test_stream_gives_the_fold(store, land, spec):
    """Batches through the stream, with compactions between, give the fold; so
    does a rebuild from the bronze they left."""
    rows = notices(3, per_batch=30)
    for batch in range(BATCHES):
        land(*(json.dumps(r) for b, r in rows if b == batch))
        ingest.ingest_available(store, source(store), clock=stamp)
    want = expected(fold(rows)[0])
    assert store.last("base") is not None
    assert summary(store.silver(), spec) == want

    landed = store.bronze().select(F.col("raw_json").alias("value"), SEQ)
    typed = clean.silver_rows(landed, spec, [SEQ])
    assert summary(rebuild.rebuild_silver(typed, spec, SEQ, stamp(SEQ)), spec) == want


def test_a_batch_may_run_twice(store, spark, spec, messages):
    """A repeated batch leaves bronze, silver and its changes as they were."""
    first = messages(payload(1), payload(2), "broken", None)
    second = messages(payload(1, 2, "b"), payload(3))
    for seq, batch in ((0, first), (1, second), (1, second)):
        ingest.ingest_batch(store, batch, "run", seq, stamp)
    assert store.bronze().count() == 6
    assert store.changes(None, 1).where(f"{SEQ} = 1").count() == 2
    found = {r.api_id: (r.numero_version, r.libelle) for r in store.silver().collect()}
    assert found == {1: (2, "b"), 2: (1, "a"), 3: (1, "a")}
    late = messages(payload(1, 1, "late"))
    ingest.ingest_batch(store, late, "run", 2, stamp)
    assert store.changes(1, 2).count() == 0


def test_an_unfinished_batch_is_not_read(store, messages, spec):
    ingest.ingest_batch(store, messages(payload(1)), "run", 0, stamp)
    typed = clean.silver_rows(messages(payload(9)), spec)
    stamps = {spec.inserted_at: stamp(1), spec.updated_at: stamp(1)}
    store.put(merge.with_digest(typed.withColumns(stamps), spec), "silver/changes", 1)
    assert [r.api_id for r in store.silver().collect()] == [1]


def test_stream_resumes_from_its_checkpoint(store, land):
    land(payload(1))
    land(payload(2))
    ingest.ingest_available(store, source(store, maxFilesPerTrigger=1))
    assert store.bronze().select(SEQ).distinct().count() == 2
    ingest.ingest_available(store, source(store))
    assert store.bronze().count() == 2
    land(payload(3))
    ingest.ingest_available(store, source(store))
    assert store.bronze().count() == 3
    ingest.ingest_available(store, source(store), stream=1)  # all over again
    assert store.bronze().count() == 6
    assert store.silver().count() == 3
    assert {r._batch_id for r in store.bronze().collect()} >= {"stream0_0", "stream1_0"}


def test_replay_of_an_unchanged_notice_makes_no_history(store, messages):
    for seq, day in enumerate(("01", "02", "03")):
        fetched = f"2026-01-{day}T00:00:00Z"
        batch = messages(payload(1, raw_ingested_at_utc=fetched))
        ingest.ingest_batch(store, batch, "run", seq, stamp)
        build.take_snapshot(store)
    assert store.bronze().count() == 3
    assert store.snapshot().count() == 1


def test_whole_runs(store, land, spark, spec):
    good = {"date_publication": "2026-01-02T00:00:00Z"}
    land(payload(1, **good), payload(2, **good), "broken")
    run = run_warehouse(store, source(store), "run-1", clock=stamp)
    assert set(run.states.values()) == {"success"} and run.failure is None
    land(payload(1, 2, "b", **good))
    run_warehouse(store, source(store), "run-2", clock=stamp)
    store.register_views()
    fact = spark.sql(
        "select deduplication_key, numero_version, nom_produit, is_current from fact_rappel"
        " join dim_produit using (produit_key) order by 1, 2"
    )
    assert [tuple(r) for r in fact.collect()] == [
        ("1", 1, "a", False),
        ("1", 2, "b", True),
        ("2", 1, "a", True),
    ]
    land(payload(4))  # no publication date: the date key test must fail
    with pytest.raises(build.TestsFailed, match="date_key"):
        run_warehouse(store, source(store), "run-3", clock=stamp)
    # Nulls were counted while gold was written: the same as a scan finds.
    seen = quality.observed_nulls(store.observed()).collect()
    tables = store.gold()
    scanned = [
        r for t, c in quality.not_null_columns(store.spec).items() for r in quality.null_counts(tables[t], t, c).collect()
    ]
    assert sorted(map(tuple, seen)) == sorted(map(tuple, scanned)) and any(r.failures for r in seen)
    rows = {r.table_name: r.counted for r in store.observed().where("column_name is null").collect()}
    assert rows == {name: df.count() for name, df in tables.items()}
    audit = store.audit().orderBy("dag_run_id").collect()
    assert [(r.dag_run_id, r.status) for r in audit] == [
        ("run-1", "success"),
        ("run-2", "success"),
        ("run-3", "failed"),
    ]
    assert (audit[1].bronze_row_count, audit[1].silver_row_count, audit[1].gold_row_count) == (4, 2, 3)


def test_a_failed_run_goes_on_where_it_failed(tmp_path, land, store, monkeypatch):
    """A failure forced at each step in turn, then the same run id: as a clean run."""
    good = {"date_publication": "2026-01-02T00:00:00Z"}
    land(payload(1, **good), payload(2, 3, "b", **good))
    calls = []
    steps = [(warehouse_run, "ingest_available"), (build, "take_snapshot"), (build, "build_gold"), (build, "run_tests")]
    for module, name in steps:
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, n=name, f=plain, **k: calls.append(n) or f(*a, **k))

    def lost(*_, **__):
        raise OSError("lost")

    for module, name in steps:
        with monkeypatch.context() as patch:
            patch.setattr(module, name, lost)
            with pytest.raises(OSError):
                run_warehouse(store, source(store), "run", clock=stamp)
    run = run_warehouse(store, source(store), "run", clock=stamp)
    assert run.states == dict.fromkeys(["ingest", "snapshot", "gold", "tests"], "success")
    # Each step was run through once, in one of the attempts.
    assert calls == [name for _, name in steps]
    assert [r.status for r in store.audit().orderBy("ended_at").collect()] == ["failed"] * 4 + ["success"]
    assert set(run_warehouse(store, source(store), "run", clock=stamp).states.values()) == {"success"}
    assert len(calls) == 4 and store.audit().count() == 5
    clean = replace(store, root=str(tmp_path / "clean"))
    run_warehouse(clean, source(store), "run", clock=stamp)
    for table in ("dim_produit", "fact_rappel"):
        assert sorted(map(str, store.gold()[table].collect())) == sorted(map(str, clean.gold()[table].collect()))
    assert sorted(map(str, store.silver().collect())) == sorted(map(str, clean.silver().collect()))


def test_a_step_is_tried_again(store, land, monkeypatch):
    land(payload(1, date_publication="2026-01-02T00:00:00Z"))
    tries, plain = [], build.take_snapshot

    def sometimes(store):
        tries.append(1)
        if len(tries) == 1:
            raise OSError("lost")
        plain(store)

    monkeypatch.setattr(build, "take_snapshot", sometimes)
    run = run_warehouse(store, source(store), "run", clock=stamp, retries=1)
    assert set(run.states.values()) == {"success"} and len(tries) == 2


def test_dimensions_from_history(store, messages, spark):
    ingest.ingest_batch(store, messages(payload(1, 1, "old")), "run", 0, stamp)
    build.take_snapshot(store)
    ingest.ingest_batch(store, messages(payload(1, 2, "new")), "run", 1, stamp)
    build.take_snapshot(store)
    for dims_from, names in (("silver", {"Unknown", "new"}), ("history", {"old", "new"})):
        build.build_gold(store, dims_from=dims_from)
        gold = store.gold()
        found = gold["fact_rappel"].join(gold["dim_produit"], "produit_key")
        assert {r.nom_produit for r in found.collect()} == names


def test_audit_is_written_when_a_step_fails(store, land):
    land(payload(1))

    def pull():
        raise OSError("source is down")

    with pytest.raises(OSError):
        run_warehouse(store, source(store), "run", pull=pull)
    (row,) = store.audit().collect()
    assert (row.status, row.bronze_row_count, row.gold_row_count) == ("failed", 0, None)


def test_pull_lands_new_records_and_moves_the_cursor(store, spark, spec):
    def pull(*days):
        rows = [(i, f"g{i % 2}", f"2026-01-{d:02d}") for i, d in enumerate(days)]
        df = spark.createDataFrame(rows, "id int, rappel_guid string, date_publication string")
        missing = [f for f in spec.schema if f.name not in df.columns]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
        df = df.withColumn("position", F.col("id"))
        return build.pull_records(store, df, "position", store.path("landing"))

    assert store.cursor() == "1900-01-01"
    assert pull(5, 6, 7) == build.Pull("2026-01-06", 1, 0)
    landed = spark.read.text(store.path("landing"))
    parsed = [json.loads(r.value) for r in landed.collect()]
    assert sorted(r["id"] for r in parsed) == [1, 2]
    assert all(r["raw_ingested_at_utc"].endswith("+00:00") for r in parsed)
    assert pull(5).cursor == "2026-01-06"  # nothing new: the cursor stays
    assert store.cursor() == "2026-01-06"


def test_replays(store, messages, spec):
    batch = messages(payload(1), payload(1, 2), "broken")
    ingest.ingest_batch(store, batch, "run", 0, stamp)
    assert [r.value for r in msg.replay(store.silver(), spec).collect()] == [payload(1, 2)]
    assert msg.replay_bronze(store.bronze(), SEQ).count() == 3


def test_copies_of_silver_wait_for_enough_changes(spark, spec, messages, tmp_path):
    store = Store(spark, str(tmp_path / "w"), spec, compact_every=1, compact_share=0.5)
    ingest.ingest_batch(store, messages(*(payload(i) for i in range(10))), "run", 0, stamp)
    assert store.last("base") == 0
    ingest.ingest_batch(store, messages(*(payload(i, 2) for i in range(4))), "run", 1, stamp)
    assert store.last("base") == 0
    ingest.ingest_batch(store, messages(payload(3, 3), payload(11)), "run", 2, stamp)
    assert store.last("base") == 2
    versions = {r.api_id: r.numero_version for r in store.silver().collect()}
    assert versions == {i: 2 if i < 3 else 1 for i in (*range(10), 11)} | {3: 3}
