"""The result row shared by every check.

Status is ``pass``, ``fail`` or ``error``; an error means that the check could
not be answered (no rows, unknown column), which is not the same as a failure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.text import params_json

PASS, FAIL, ERROR = "pass", "fail", "error"

RESULT_COLUMNS = [
    "check", "target", "group_key", "status", "violations", "observed", "expected", "params",
]

RESULT_SCHEMA = (
    "check string, target string, group_key string, status string, "
    "violations bigint, observed string, expected string, params string"
)


def status_of(violations: Column, unanswerable: Column | None = None) -> Column:
    status = F.when(violations == 0, PASS).otherwise(FAIL)
    if unanswerable is None:
        return status
    return F.when(unanswerable, ERROR).otherwise(status)


def verdict_columns(
    check: str,
    target: str | Column,
    violations: Column,
    observed: Column | None = None,
    expected: Column | None = None,
    params: dict | None = None,
    group_key: Column | None = None,
    unanswerable: Column | None = None,
) -> list[Column]:
    """Result columns for rows that already hold their measures."""
    text = F.lit(None).cast("string")
    return [
        F.lit(check).alias("check"),
        (F.lit(target) if isinstance(target, str) else target).alias("target"),
        (text if group_key is None else group_key).alias("group_key"),
        status_of(violations, unanswerable).alias("status"),
        violations.cast("bigint").alias("violations"),
        (text if observed is None else observed.cast("string")).alias("observed"),
        (text if expected is None else expected.cast("string")).alias("expected"),
        params_json(params or {}).alias("params"),
    ]


def error_row(spark: SparkSession, check: str, target: str, message: str, params: dict | None = None) -> DataFrame:
    """One result row for a check that Spark could not analyse."""
    return spark.range(1).select(
        F.lit(check).alias("check"), F.lit(target).alias("target"),
        F.lit(None).cast("string").alias("group_key"),
        F.lit(ERROR).alias("status"), F.lit(None).cast("bigint").alias("violations"),
        F.lit(message).alias("observed"), F.lit(None).cast("string").alias("expected"),
        params_json(params or {}).alias("params"),
    )


def group_text(columns: list[str]) -> Column:
    """Group columns as JSON text, null when there are none."""
    if not columns:
        return F.lit(None).cast("string")
    return F.to_json(F.struct(*columns))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
