"""What a store moves and writes: rows of a single set do not meet, a copy moves its rows
once, files are zstd."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from noticehouse.operators import clean, merge
from noticehouse.plans import build
from noticehouse.sources import messages as msg
from noticehouse.sources.store import BUCKET, SEQ, Store


def change_set(store, messages, seq, *versions):
    """A batch's change set, written as a merge writes it."""
    sent = messages(*({"id": k, "numero_version": v, "libelle": f"{k}-{v}"} for k, v in versions))
    at = F.expr(f"timestamp'2026-01-01 00:00:00' + make_dt_interval({seq})")
    stamps = {store.spec.inserted_at: at, store.spec.updated_at: at}
    rows = clean.silver_rows(sent, store.spec).transform(merge.with_digest, store.spec).withColumns(stamps)
    store.put(rows.select(*store._stored.names), "silver/changes", seq)
    store.commit(("bronze", seq, "s", seq), ("silver", seq))


@pytest.fixture
def store(spark, spec, tmp_path, messages):
    made = Store(spark, str(tmp_path / "sets"), spec)
    change_set(made, messages, 0, (1, 1), (2, 1), (3, 1))
    change_set(made, messages, 1, (1, 2), (4, 1))
    return made


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def found(df):
    return sorted((r.api_id, r.numero_version) for r in df.collect())


def test_rows_of_a_single_set_do_not_meet(store, spark):
    keys = spark.createDataFrame([("1",), ("3",)], f"{store.spec.key} string")
    for single in (store.newest_changes(None, 0), store.newest_changes(0, 1)):
        assert "Window" not in plan(single) and "Exchange" not in plan(single)
    assert "Window" not in plan(store.stored_for(keys, 1))
    assert found(store.stored_for(keys, 1, [store.spec.key, "api_id", "numero_version"])) == [(1, 1), (3, 1)]
    assert found(store.newest_changes(None, 1)) == [(1, 2), (2, 1), (3, 1), (4, 1)]
    assert found(store.stored_for(keys, 2, [store.spec.key, "api_id", "numero_version"])) == [(1, 2), (3, 1)]


def test_a_copy_moves_its_rows_once(store, messages, monkeypatch):
    """Copy and changes go to the buckets as they are, and the newest is taken there."""
    given, whole = [], Store.copy
    monkeypatch.setattr(Store, "copy", lambda self, rows, *more: given.append(rows) or whole(self, rows, *more))
    store.compact(1)
    change_set(store, messages, 2, (2, 5), (5, 1))
    before = found(store.silver())
    store.compact(2)
    assert not any(word in plan(rows) for rows in given for word in ("Exchange", "Window", "Join"))
    copied = store._base(2)
    assert found(copied) == found(store.silver()) == before == [(1, 2), (2, 5), (3, 1), (4, 1), (5, 1)]
    assert set(copied.columns) == {*store._stored.names, BUCKET} and SEQ not in copied.columns


def test_the_fact_reads_the_staged_rows(store, monkeypatch):
    """Open versions are silver, whose columns were just written."""
    build.take_snapshot(store)
    given, whole = [], Store.snapshot
    monkeypatch.setattr(Store, "snapshot", lambda self, silver=None: given.append(silver) or whole(self, silver))
    build.build_gold(store)
    assert given[-1] is not None and given[-1].columns == list(store.spec.staging_columns)
    fact = store.gold()["fact_rappel"]
    assert sorted(r.numero_version for r in fact.where("is_current").collect()) == [1, 1, 1, 2]


def test_the_fact_is_as_of_the_snapshot(store, messages):
    """Silver has moved on since: the open versions are not its rows."""
    build.take_snapshot(store)
    change_set(store, messages, 2, (2, 5), (5, 1))
    build.build_gold(store)
    fact = store.gold()["fact_rappel"]
    assert sorted(r.numero_version for r in fact.where("is_current").collect()) == [1, 1, 1, 2]


def test_files_are_zstd(store, messages, tmp_path):
    msg.write_messages(messages({"id": 1}), str(tmp_path / "landing"), "parquet")
    for folder in (tmp_path / "landing", tmp_path / "sets" / "silver" / "changes" / "seq=0"):
        file = max(folder.glob("*.parquet"), key=lambda f: f.stat().st_size)
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
