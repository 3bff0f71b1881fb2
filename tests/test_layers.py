"""The layers that gold queries read."""

import pyarrow.parquet as pq

import __spark_entry__ as entry
from checks import queries
from noticehouse.operators import history
from noticehouse.session import scratch_path

SPEC = queries.SPEC


def of_whole_states(built):
    """The same snapshots, each taken of all that stood."""
    first, *later = (history.snapshot_source(built.staged(b), SPEC) for b in queries.SNAPSHOT_AFTER)
    taken = history.open_versions(first, SPEC)
    for source in later:
        taken = history.take_snapshot(taken, source, SPEC)
    return taken


def test_snapshots_meet_what_changed(spark, monkeypatch):
    built = queries.Layers(spark, entry.SMALL, scratch_path(spark, "layers"))
    want = of_whole_states(built)
    met, take = [], history.take_snapshot

    def spy(taken, source, spec):
        met.append(source)
        return take(taken, source, spec)

    monkeypatch.setattr(history, "take_snapshot", spy)
    found = built.snapshot()
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert found.where("dbt_valid_to is not null").count() > 0
    # Each row that is met opens a version: none is moved to do nothing.
    assert sum(source.count() for source in met) == found.count() - built.staged(queries.SNAPSHOT_AFTER[0]).count()
    assert [s.count() < built.staged(b).count() for s, b in zip(met, queries.SNAPSHOT_AFTER[1:])] == [True, True]


def test_layers_are_written_small(spark, tmp_path):
    built = queries.Layers(spark, entry.SMALL, str(tmp_path))
    built.table("some", lambda: spark.range(9))
    file = next((tmp_path / "some").glob("*.parquet"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
