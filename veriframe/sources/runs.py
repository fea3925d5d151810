"""Exported run metadata as one row per task run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DOCUMENT = """
    job_id bigint, run_id bigint, run_name string,
    state struct<life_cycle_state: string, result_state: string, state_message: string>,
    start_time bigint, end_time bigint,
    setup_duration bigint, execution_duration bigint, run_duration bigint,
    tasks array<struct<
        task_key: string, run_id: bigint,
        state: struct<life_cycle_state: string, result_state: string, state_message: string>,
        start_time: bigint, end_time: bigint,
        setup_duration: bigint, execution_duration: bigint>>
"""


def read_runs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Run documents. One document per line keeps large exports splittable."""
    return spark.read.schema(RUN_DOCUMENT).option("multiLine", multi_line).json(path)


def run_records(runs: DataFrame) -> DataFrame:
    """One row per run, without its tasks."""
    return runs.select(
        "job_id", "run_id", "run_name",
        F.col("state.life_cycle_state").alias("life_cycle_state"),
        "start_time", "end_time", "setup_duration", "execution_duration", "run_duration",
    )


def flatten_tasks(runs: DataFrame) -> DataFrame:
    """One row per task run."""
    task = F.col("task")
    return runs.select(
        "job_id", "run_id", "run_name",
        F.col("state.life_cycle_state").alias("run_life_cycle_state"),
        F.explode("tasks").alias("task"),
    ).select(
        "job_id", "run_id", "run_name", "run_life_cycle_state",
        task.task_key.alias("task_key"),
        task.run_id.alias("task_run_id"),
        task.state.life_cycle_state.alias("life_cycle_state"),
        task.state.result_state.alias("result_state"),
        task.state.state_message.alias("state_message"),
        task.start_time.alias("start_time"),
        task.end_time.alias("end_time"),
        task.setup_duration.alias("setup_duration"),
        task.execution_duration.alias("execution_duration"),
    )
