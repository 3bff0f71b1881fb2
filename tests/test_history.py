import datetime as dt

import pytest
from pyspark.sql import functions as F

from noticehouse.operators import history
from noticehouse.operators.rebuild import VALID_FROM, VALID_TO


def day(n):
    return dt.datetime(2026, 1, n)


@pytest.fixture
def source(spark, spec):
    def build(**stamps):
        df = spark.createDataFrame(
            [(k, d, f"{k}{d}") for k, d in stamps.items()], f"{spec.key} string, d int, text string"
        )
        silver = df.withColumn(
            spec.updated_at, F.expr("timestamp'2026-01-01 00:00:00' + make_dt_interval(d - 1)")
        )
        return history.snapshot_source(silver, spec, without=["d"])

    return build


def intervals(df, spec):
    rows = df.select(spec.key, "text", VALID_FROM, VALID_TO).collect()
    return sorted(map(tuple, rows), key=str)


def test_snapshot_rules(source, spec):
    """New key, newer stamp, same stamp, older stamp, key gone, closed row."""
    first = history.open_versions(source(newer=1, same=1, gone=1, older=5), spec)
    second = history.take_snapshot(first, source(newer=3, same=1, older=4, new=3), spec)
    third = history.take_snapshot(second, source(newer=4), spec)
    assert intervals(third, spec) == [
        ("gone", "gone1", day(1), None),
        ("new", "new3", day(3), None),
        ("newer", "newer1", day(1), day(3)),
        ("newer", "newer3", day(3), day(4)),
        ("newer", "newer4", day(4), None),
        ("older", "older5", day(5), None),
        ("same", "same1", day(1), None),
    ]
    assert third.columns == first.columns
    ids = [r[history.ROW_ID] for r in third.collect()]
    assert len(set(ids)) == len(ids)


def test_append_only_versions_give_the_same_intervals(source, spec):
    runs = [dict(a=1, b=1), dict(a=2, b=1), dict(a=4, c=4)]
    taken, versions = None, None
    for run in runs:
        rows = source(**run)
        if taken is None:
            taken = history.open_versions(rows, spec)
            versions = taken.drop(VALID_TO)
            continue
        taken = history.take_snapshot(taken, rows, spec)
        fresh = history.open_versions(rows, spec).drop(VALID_TO)
        versions = versions.unionByName(fresh).dropDuplicates([history.ROW_ID])
    appended = history.intervals_from_versions(versions, spec)
    assert intervals(appended, spec) == intervals(taken, spec)


def test_interval_columns(source, spec):
    taken = history.open_versions(source(a=1), spec)
    taken = history.take_snapshot(taken, source(a=2), spec)
    rows = taken.select("text", *history.interval_columns()).orderBy("text").collect()
    assert [tuple(r) for r in rows] == [
        ("a1", day(1), day(2), False),
        ("a2", day(2), None, True),
    ]
