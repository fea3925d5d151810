"""Suites: many checks on one table, as few passes as possible.

Row checks share one aggregate. Every other check is a function that returns
result rows. A check that Spark cannot analyse becomes an error row; anything
else fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from veriframe.operators.row_checks import RowCheck, run_row_checks
from veriframe.operators.verdict import RESULT_COLUMNS, error_row, union_all

TableCheck = Callable[[DataFrame], DataFrame]


def run_suite(df: DataFrame, checks: Sequence[RowCheck | tuple[str, TableCheck]]) -> DataFrame:
    """Result rows of all checks. Table checks come as (name, function)."""
    fused, frames = [], []
    for check in checks:
        if isinstance(check, RowCheck):
            problem = _problem(df, check)
            if problem is None:
                fused.append(check)
            else:
                frames.append(error_row(df.sparkSession, check.check, check.target, problem, check.params))
            continue
        name, function = check
        try:
            frames.append(function(df).select(*RESULT_COLUMNS))
        except AnalysisException as error:
            frames.append(error_row(df.sparkSession, name, "*", str(error)))
    if fused:
        frames.insert(0, run_row_checks(df, fused))
    return union_all(frames)


def _problem(df: DataFrame, check: RowCheck) -> str | None:
    try:
        df.agg(*check.measures.values())
    except AnalysisException as error:
        return str(error)
    return None
