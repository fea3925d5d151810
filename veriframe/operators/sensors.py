"""Sensor result rows, their checks and the readiness gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.functions.time import day_text
from veriframe.operators.logs import latest_rows
from veriframe.operators.sets import check_sets

# Text of the gate's error and layout of a rule's name.
NOT_READY = "Sensor module detected not-ready prerequisite tasks"
RULE = "AnomalyConstraint(Mean(value,Some(name='%s' and instance='%s')))"

SENSOR_KEYS = ["upstrm_pl", "dt", "snsr_rule"]


def rule_text(name: str, instance: str) -> Column:
    """Name of the mean-of-history rule for one metric, from two columns."""
    return F.format_string(RULE, name, instance)


def sensor_results(anomalies: DataFrame, parent_run_id: str, pipeline: str) -> DataFrame:
    """Anomaly verdicts (day, instance, name, is_ready) as sensor rows."""
    return anomalies.select(
        F.lit(parent_run_id).alias("parent_run_id"), F.lit(pipeline).alias("upstrm_pl"),
        F.col("day").alias("dt"), rule_text("name", "instance").alias("snsr_rule"),
        "is_ready",
    )


def rules_with_flag(sensor: DataFrame, ready: bool) -> DataFrame:
    """Rows whose flag is the given one; an unknown flag is neither."""
    return sensor.where(F.col("is_ready").eqNullSafe(F.lit(ready)))


def check_sensor_rules(
    sensor: DataFrame, expected_rules: Sequence[str], by: Sequence[str], ready: bool = False,
    required: DataFrame | None = None,
) -> DataFrame:
    """Rows with the given flag equal an expected set, per group; required groups without any row miss all of it."""
    groups = sensor.select(*by)
    if required is not None:
        groups = groups.unionByName(required.select(*by))
    expected = groups.distinct().withColumn("snsr_rule", F.explode(F.array(*[F.lit(r) for r in expected_rules])))
    return check_sets(rules_with_flag(sensor, ready), expected, "snsr_rule", by)


def check_sensor_dates(sensor: DataFrame, expected: DataFrame, by: Sequence[str], column: str = "dt") -> DataFrame:
    """Dates per group equal the expected ones, compared as text."""
    actual = sensor.select(*by, day_text(F.col(column)).alias("date"))
    return check_sets(actual, expected.select(*by, "date"), "date", by)


def latest_sensor(sensor: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The newest row itself per pipeline, date and rule of a period."""
    order = [F.col("result_ts").desc(), F.col("parent_run_id").desc()]
    return latest_rows(sensor.where(F.col("dt").between(start, end)), SENSOR_KEYS, order)


def gate(sensor: DataFrame, start: dt.date, end: dt.date, required: DataFrame | None = None) -> DataFrame:
    """Readiness per pipeline and date: all newest results must be ready, unknown counts as not ready.

    ``required`` lists pipelines, dates and rules of the period that must have
    reported; one that did not counts as a rule that is not ready.

    A rule is ready when its newest ready result is later than its newest other
    one, so at the same moment not ready wins. Two maxima per rule need neither
    a sort nor the rows themselves.
    """
    ready, moment = F.coalesce("is_ready", F.lit(False)), F.col("result_ts")
    reported = sensor.where(F.col("dt").between(start, end)).select(
        *SENSOR_KEYS, F.when(ready, moment).alias("_ready"), F.when(~ready, moment).alias("_other"), F.lit(1).alias("_rows")
    )
    if required is not None:
        never = F.lit(None).cast(reported.schema["_ready"].dataType)
        reported = reported.unionByName(required.where(F.col("dt").between(start, end)).select(
            *SENSOR_KEYS, never.alias("_ready"), never.alias("_other"), F.lit(0).alias("_rows")
        ))
    rules = reported.groupBy(*SENSOR_KEYS).agg(
        F.max("_ready").alias("_ready"), F.max("_other").alias("_other"), F.max("_rows").alias("_rows")
    )
    unready = F.col("_other").isNotNull() & ~F.coalesce(F.col("_ready") > F.col("_other"), F.lit(False))
    late = unready | (F.col("_rows") == 0)
    return rules.groupBy("upstrm_pl", "dt").agg(
        F.count(F.lit(1)).alias("rules"), F.sum(late.cast("bigint")).alias("not_ready")
    ).select(
        "upstrm_pl", "dt", "rules", "not_ready", (F.col("not_ready") == 0).alias("is_ready"),
        F.when(F.col("not_ready") > 0, NOT_READY).alias("message"),
    )
