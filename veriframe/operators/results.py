"""Result tables: run columns, timings and parameter combinations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.operators.runs import run_information, task_durations
from veriframe.operators.verdict import FAIL, PASS

# Workflow name of results without a run, outcome texts.
NO_RUN = "skip"
SUCCESS_TEXT, FAILURE_PREFIX = "Success", "AssertionError: "

RUN_COLUMNS = {
    "workflow_start_time": "timestamp", "workflow_end_time": "timestamp",
    "workflow_setup_duration": "double", "workflow_execution_duration": "double",
}


def with_run(results: DataFrame, runs: DataFrame | None, test_param: dict | None = None) -> DataFrame:
    """Result rows with the columns of their run, or the skip marker when there is no run.

    Rows meet their run on ``run_id``. Rows without that column are results of the
    one run given; more than one run fails the job.
    """
    param = F.lit(None).cast("string")
    if test_param:
        pairs = [F.lit(str(x)) for item in test_param.items() for x in item]
        param = F.to_json(F.create_map(*pairs))
    if runs is None:
        blank = {c: F.lit(None).cast(t) for c, t in RUN_COLUMNS.items()}
        rows = results.withColumn("workflow_name", F.lit(NO_RUN)).withColumns(blank)
    else:
        information = run_information(runs)
        if "run_id" in results.columns:
            rows = results.join(information, "run_id", "left")
        else:
            one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("results belong to one run"))).otherwise(F.first(F.struct(*information.columns)))
            rows = results.withColumn("_run", information.agg(one).scalar()).select("*", "_run.*").drop("_run")
    return rows.withColumn("test_param", param)


def assertion_rows(results: DataFrame, area: str) -> DataFrame:
    """Check results in the shape of the assertion report: area, check, parameters, outcome text."""
    detail = F.concat_ws(
        " ", F.col("check"), F.lit("of"), F.col("target"), F.concat(F.lit("found "), F.col("observed")),
        F.concat(F.lit("expected "), F.col("expected")),
    )
    outcome = (
        F.when(F.col("status") == PASS, SUCCESS_TEXT)
        .when(F.col("status") == FAIL, F.concat(F.lit(FAILURE_PREFIX), detail))
        .otherwise(F.coalesce("observed", detail))
    )
    return results.select(
        F.lit(area).alias("test_area"), F.col("check").alias("assertions"),
        F.col("params").alias("log_params"), outcome.alias("assertion_result"),
    )


def timing_rows(task_runs: DataFrame, runs: DataFrame) -> DataFrame:
    """One timing row per task run, with its run's columns."""
    nothing = F.lit(None).cast("string")
    rows = task_durations(task_runs).select(
        "run_id", "task_run_id", F.col("task_key").alias("task_name"), nothing.alias("sub_process"),
        nothing.alias("log_params"), "start_time", "end_time", "setup_duration", "execution_duration",
    )
    return with_run(rows, runs)


def parameter_matrix(configs: DataFrame, parameters: Mapping[str, Sequence]) -> DataFrame:
    """Each configuration once per combination of parameter values."""
    rows = configs
    for name, values in parameters.items():
        rows = rows.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    combination = F.to_json(F.create_map(*[
        x for name in parameters for x in (F.lit(name), F.col(name).cast("string"))
    ]))
    return rows.withColumn("test_param", combination)


def append_results(results: DataFrame, path: str) -> None:
    results.write.mode("append").parquet(path)
