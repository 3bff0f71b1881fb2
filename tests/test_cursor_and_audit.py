import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from noticehouse.functions.dates import parse_publication
from noticehouse.operators import audit, cursor, reports


def dated(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "published string")


MOMENT = "published"


def moment():
    return parse_publication(F.col(MOMENT))


def test_cursor_steps_back_a_day(spark):
    df = dated(spark, "2026-06-29T12:30:00+00:00", "not-a-date", None)
    assert cursor.next_cursor(df, moment(), "1900-01-01").first()[0] == "2026-06-28"


def test_cursor_stays_without_valid_dates(spark):
    for df in (dated(spark, "not-a-date"), dated(spark)):
        assert cursor.next_cursor(df, moment(), "2026-01-05").first()[0] == "2026-01-05"


def test_incremental_is_after_the_cursor_and_sorted(spark):
    df = dated(spark, "2026-01-03", "2026-01-02T00:00:01", "2026-01-02", "2026-01-01", None)
    rows = cursor.incremental(df, moment(), "2026-01-02").collect()
    assert [r.published for r in rows] == ["2026-01-02T00:00:01", "2026-01-03"]


def test_capped_pull(spark):
    days = dated(spark, *(f"2026-01-{d:02d}" for d in range(1, 21)))
    args = (days, moment(), "2025-12-31")
    assert cursor.advance(*args, limit=10) == cursor.Advance("2026-01-09", True)
    assert cursor.advance(*args, limit=100) == cursor.Advance("2025-12-31", False)
    with pytest.raises(cursor.CursorStuck):
        cursor.advance(days, moment(), "2026-01-04", limit=1)


def test_pages_equal_pulls_one_by_one(spark):
    """All pages from one read, as pull after pull gives them; some moments lie at the
    very start of a day, some are null."""
    rng = random.Random(2)
    for limit in (3, 7, 40):
        days = [(rng.choice([None, 0, 0, 1, 2, 5, 9]), rng.choice([0, 0, 1, 3600])) for _ in range(60)]
        rows = [(None if d is None else f"2026-01-{d + 1:02d} {s // 3600:02d}:00:{s % 60:02d}",) for d, s in days]
        df = spark.createDataFrame(rows, "at string").select(F.col("at").cast("timestamp_ntz").alias("at"))
        one = [cursor.pull_status(df, F.col("at"), "2026-01-01", limit=limit).first()]
        while one[-1].status == "advanced":
            one.append(cursor.pull_status(df, F.col("at"), one[-1].next_cursor, limit=limit).first())
        found = cursor.pages(df, F.col("at"), "2026-01-01", limit=limit)
        assert list(map(tuple, found)) == list(map(tuple, one))


def test_pages_of_a_capped_pull(spark):
    days = dated(spark, *(f"2026-01-{d:02d}" for d in range(1, 21)))
    found = cursor.pages(days, moment(), "2025-12-31", limit=10)
    assert [(r.cursor, r.pulled, r.status, r.next_cursor) for r in found] == [
        ("2025-12-31", 10, "advanced", "2026-01-09"),
        ("2026-01-09", 10, "advanced", "2026-01-18"),
        ("2026-01-18", 2, "exhausted", "2026-01-18"),
    ]
    stuck = cursor.pages(days, moment(), "2026-01-04", limit=1)
    assert [r.status for r in stuck] == ["stuck"]


STATES = {
    "all-good": (["success", "success"], "success"),
    "one-failed": (["success", "failed"], "failed"),
    "upstream": (["success", "upstream_failed"], "failed"),
    "skipped": (["success", "skipped"], "partial"),
    "unknown": (["success", None], "partial"),
    "alone": ([], "success"),
}


def test_run_status_leaves_out_its_own_step(spark):
    rows = [
        (run, f"t{i}", state) for run, (states, _) in STATES.items() for i, state in enumerate(states)
    ] + [(run, "log_audit", "running") for run in STATES]
    steps = spark.createDataFrame(rows, "run string, task_id string, state string")
    found = audit.run_status(steps, "run", F.col("task_id") == "log_audit").collect()
    assert {r.run: r.status for r in found} == {run: want for run, (_, want) in STATES.items()}


def test_audit_row(spark):
    start = dt.datetime(2026, 1, 1)
    runs = spark.createDataFrame([("r", start, "success")], "dag_run_id string, started_at timestamp, status string")
    counts = {"bronze": F.lit(10), "silver": F.lit(5), "gold": F.lit(None)}
    ended = F.expr("timestamp'2026-01-01 00:01:30.5'")
    (row,) = audit.audit_rows(runs, ended, counts).collect()
    assert row.duration_seconds == 90.5
    assert (row.bronze_row_count, row.gold_row_count) == (10, None)
    assert row.details == '{"bronze":10,"silver":5,"gold":null}'
    assert reports.recent_runs(audit.audit_rows(runs, ended, counts)).count() == 1


def test_a_hot_moment_is_sorted_by_many_tasks(spark):
    df = spark.range(0, 20_000, 1, 4).selectExpr(
        "id", "case when id % 3 = 0 then timestamp_ntz'2026-02-01' else timestamp_ntz'2026-02-01'"
        " + make_dt_interval(0, 0, 0, id - 10000) end as at",
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = cursor.incremental(df, F.col("at"), "2026-01-01")
        parts = found.select("at", F.spark_partition_id().alias("p")).where(
            "at = timestamp_ntz'2026-02-01'"
        )
        assert parts.select("p").distinct().count() > 1
        assert found.count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
