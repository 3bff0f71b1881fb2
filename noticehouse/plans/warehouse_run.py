"""One run of the whole warehouse, audited whatever happens."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticehouse.operators import audit, reports
from noticehouse.plans import build, maintain
from noticehouse.sources.store import Store
from noticehouse.streaming.ingest import Clock, ingest_available, wall_clock

log = logging.getLogger(__name__)

Step = tuple[str, Callable[[], object]]
AUDIT_STEP = "log_audit"


@dataclass(frozen=True)
class Run:
    """The state of each step, and what the failed one raised."""

    states: dict[str, str]
    failure: Exception | None = None


def row_counts(store: Store) -> dict[str, int | None]:
    """Rows per layer; a gold that was never built counts as null."""
    layers = {"bronze": store.bronze(), "silver": store.silver()}
    gold = store.gold()
    if gold is not None:
        layers["gold"] = gold[store.spec.fact.name]
    counted = reports.layer_counts(layers).collect()
    return dict.fromkeys(audit.LAYERS) | {r.layer: r.row_count for r in counted}


def run_steps(
    steps: Sequence[Step],
    done: Collection[str] = (),
    record: Callable[[str, str], object] | None = None,
    retries: int = 0,
) -> Run:
    """Run in order; after a failure the rest is marked and left out.

    Steps ``done`` before are not run again. Every state is recorded as soon as it
    is known, so that a run cut off by anything goes on where it stopped.
    """
    states: dict[str, str] = {}
    failure = None
    for name, action in steps:
        if failure is not None:
            states[name] = "upstream_failed"
            continue
        if name in done:
            states[name] = audit.SUCCESS_STATE
            continue
        for left in range(retries, -1, -1):
            try:
                action()
                states[name] = audit.SUCCESS_STATE
                break
            except Exception as error:
                log.exception("step %s failed, %d tries left", name, left)
                if not left:
                    states[name], failure = audit.FAILED, error
        if record is not None:
            record(name, states[name])
    return Run(states, failure)


def write_audit(
    store: Store, run_id: str, states: dict[str, str], started_at: dt.datetime
) -> None:
    steps = store.spark.createDataFrame(
        [(run_id, task, state) for task, state in {**states, AUDIT_STEP: "running"}.items()],
        "dag_run_id string, task_id string, state string",
    )
    status = audit.run_status(steps, "dag_run_id", F.col("task_id") == AUDIT_STEP)
    runs = status.withColumn("started_at", F.lit(started_at).cast("timestamp"))
    counts = {layer: F.lit(n) for layer, n in row_counts(store).items()}
    store.add_audit(audit.audit_rows(runs, F.current_timestamp(), counts))


def run_warehouse(
    store: Store,
    messages: DataFrame,
    run_id: str,
    *,
    pull: Callable[[], object] | None = None,
    stream: int = 0,
    clock: Clock = wall_clock,
    raise_on_failure: bool = True,
    retries: int = 0,
    **options: bool,
) -> Run:
    """Pull, ingest, snapshot, gold, tests; then the audit row, and old gold builds
    and copies of silver are removed.

    A run id that failed before goes on at the step that failed; one that is
    complete is not run again. Each step may be tried ``retries`` times more; all of
    them may be repeated.
    """
    started_at = dt.datetime.now(dt.timezone.utc)
    done = store.steps_done(run_id)
    if AUDIT_STEP in done:
        return Run({name: audit.SUCCESS_STATE for name in done if name != AUDIT_STEP})
    steps: list[Step] = [
        (
            "ingest",
            lambda: ingest_available(
                store, messages, stream=stream, clock=clock, **options
            ),
        ),
        ("snapshot", lambda: build.take_snapshot(store)),
        ("gold", lambda: (build.build_gold(store), maintain.update_counts(store))),
        ("tests", lambda: build.run_tests(store)),
    ]
    if pull is not None:
        steps.insert(0, ("pull", pull))
    run = run_steps(steps, done, lambda name, state: store.add_step(run_id, name, state), retries)
    try:
        write_audit(store, run_id, run.states, started_at)
    except Exception as error:
        # What went wrong first is the cause.
        raise error from run.failure
    if run.failure is not None and raise_on_failure:
        raise run.failure
    if run.failure is None:
        store.add_step(run_id, AUDIT_STEP, audit.SUCCESS_STATE)
    store.retain()
    return run
