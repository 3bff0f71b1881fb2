"""Run status and audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Step states and run statuses.
FAILED_STATES = ("failed", "upstream_failed")
SUCCESS_STATE = "success"
FAILED, SUCCESS, PARTIAL = "failed", "success", "partial"

LAYERS = ("bronze", "silver", "gold")


def status_of(state: Column) -> Column:
    """Aggregate over step states; a run without other steps is a success."""
    return (
        F.when(F.bool_or(state.isin(*FAILED_STATES)), FAILED)
        .when(F.coalesce(F.bool_and(state == SUCCESS_STATE), F.lit(True)), SUCCESS)
        .otherwise(PARTIAL)
    )


def run_status(steps: DataFrame, run: str, own_step: Column) -> DataFrame:
    """Status of each run from its other steps' states.

    Columns ``task_id`` and ``state``; ``own_step`` tells the step that asks.
    The step states fold inside the map tasks.
    """
    state = F.when(~own_step, F.coalesce("state", F.lit("none")))
    return steps.groupBy(run).agg(status_of(state).alias("status"))


def audit_rows(
    runs: DataFrame, ended_at: Column, counts: dict[str, Column]
) -> DataFrame:
    """Audit rows from ``dag_run_id``, ``started_at``, ``status``.

    A layer that does not exist has a null count, in its column and in the
    details.
    """
    took = F.col("ended_at").cast("timestamp").cast("double") - F.col("started_at").cast(
        "timestamp"
    ).cast("double")
    details = F.struct(*(F.col(f"{layer}_row_count").alias(layer) for layer in LAYERS))
    return (
        runs.withColumn("ended_at", ended_at)
        .withColumns({f"{layer}_row_count": counts[layer].cast("bigint") for layer in LAYERS})
        .select(
            "dag_run_id",
            "started_at",
            "ended_at",
            F.round(took, 6).alias("duration_seconds"),
            "status",
            *(f"{layer}_row_count" for layer in LAYERS),
            F.to_json(details, {"ignoreNullFields": "false"}).alias("details"),
        )
    )
