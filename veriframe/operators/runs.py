"""Checks on run and task states, and task timings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.functions.time import epoch_to_timestamp, run_seconds, seconds
from veriframe.operators.verdict import FAIL, PASS

# States of runs and tasks.
SUCCESS = "SUCCESS"
TERMINATED = "TERMINATED"
SKIPPED, UPSTREAM_FAILED = "SKIPPED", "UPSTREAM_FAILED"

# Layouts of the messages.
FAILED_TASK = "Result status of task_key:%s, run_id:%s, %s, %s."
UNFINISHED_RUN = "Result life cycle state of run_name:%s, run_id:%s is %s."


def failed_tasks(task_runs: DataFrame) -> DataFrame:
    """Every task run without success, one row each, with its message."""
    rows = task_runs.where(~F.col("result_state").eqNullSafe(SUCCESS))
    message = F.format_string(
        FAILED_TASK, "task_key", "task_run_id",
        F.coalesce("result_state", F.lit("None")), F.coalesce("state_message", F.lit("None")),
    )
    return rows.select("run_id", "task_run_id", "task_key", "result_state", message.alias("message"))


def check_tasks_complete(task_runs: DataFrame) -> DataFrame:
    """A run passes when each of its tasks succeeded."""
    failed = F.sum((~F.col("result_state").eqNullSafe(SUCCESS)).cast("bigint"))
    return task_runs.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("tasks"), failed.alias("not_successful")
    ).select(
        "run_id", "tasks", "not_successful",
        F.when(F.col("not_successful") == 0, PASS).otherwise(FAIL).alias("status"),
    )


def check_run_terminated(runs: DataFrame, task_runs: DataFrame) -> DataFrame:
    """A run must be terminated first, and then each task successful; the message names every task that failed, of which a run has few."""
    tasks = check_tasks_complete(task_runs).select("run_id", "not_successful")
    named = failed_tasks(task_runs).groupBy("run_id").agg(F.array_join(F.array_sort(F.collect_list("message")), " ").alias("_failed"))
    ended = F.col("life_cycle_state").eqNullSafe(TERMINATED)
    failed = F.coalesce("not_successful", F.lit(0))
    return runs.select("run_id", "run_name", "life_cycle_state").join(tasks, "run_id", "left").join(named, "run_id", "left").select(
        "run_id", "life_cycle_state", failed.cast("bigint").alias("not_successful"),
        F.when(ended & (failed == 0), PASS).otherwise(FAIL).alias("status"),
        F.when(~ended, F.format_string(
            UNFINISHED_RUN, "run_name", "run_id", F.coalesce("life_cycle_state", F.lit("None"))
        )).otherwise(F.col("_failed")).alias("message"),
    )


def check_downstream_skipped(task_runs: DataFrame, downstream: Sequence[str], runs: DataFrame | None = None) -> DataFrame:
    """Listed tasks that are present must be skipped because of an upstream failure.

    A listed task that a run does not have does not fail it, but is counted. With
    ``runs``, a frame of ``run_id``, runs without any listed task fail.
    """
    listed = task_runs.where(F.col("task_key").isin(*downstream))
    skipped = F.col("life_cycle_state").eqNullSafe(SKIPPED) & F.col("result_state").eqNullSafe(UPSTREAM_FAILED)
    # One flag per listed task keeps the aggregate free of distinct counts.
    present = sum(
        [F.max((F.col("task_key") == name).cast("bigint")) for name in downstream], F.lit(0)
    )
    found = listed.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("present"),
        F.sum((~skipped).cast("bigint")).alias("not_skipped"),
        (F.lit(len(downstream)) - present).cast("bigint").alias("missing"),
    )
    if runs is not None:
        found = runs.select("run_id").distinct().join(found, "run_id", "left").select(
            "run_id", F.coalesce("present", F.lit(0)).alias("present"), F.coalesce("not_skipped", F.lit(0)).alias("not_skipped"),
            F.coalesce("missing", F.lit(len(downstream))).cast("bigint").alias("missing"),
        )
    good = (F.col("not_skipped") == 0) & (F.col("present") > 0)
    return found.withColumn("status", F.when(good, PASS).otherwise(FAIL))


def task_durations(task_runs: DataFrame) -> DataFrame:
    """Times and durations in seconds, one row per task run."""
    return task_runs.select(
        "run_id", "task_run_id", "task_key",
        epoch_to_timestamp(F.col("start_time")).alias("start_time"),
        epoch_to_timestamp(F.col("end_time")).alias("end_time"),
        seconds(F.col("setup_duration")).alias("setup_duration"),
        seconds(F.col("execution_duration")).alias("execution_duration"),
    )


def run_information(runs: DataFrame) -> DataFrame:
    """The run columns that result rows carry."""
    return runs.select(
        "run_id",
        F.col("run_name").alias("workflow_name"),
        epoch_to_timestamp(F.col("start_time")).alias("workflow_start_time"),
        epoch_to_timestamp(F.col("end_time")).alias("workflow_end_time"),
        seconds(F.col("setup_duration")).alias("workflow_setup_duration"),
        run_seconds(F.col("run_duration"), F.col("execution_duration")).alias("workflow_execution_duration"),
    )
