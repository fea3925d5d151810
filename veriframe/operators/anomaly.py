"""Anomaly rules over metric history: (day, instance, name, value) rows.

A metric table holds one row per day and metric, so a window over one metric
is as long as its history. Without any history the answer is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriframe.functions.time import previous_month_end

KEYS = ["instance", "name"]


def within(value: Column, reference: Column, absolute: float = 0.0, relative: float = 0.0) -> Column:
    """The value is as close to its reference as the wider of two bounds allows."""
    bound = F.greatest(F.lit(absolute), F.lit(relative) * F.abs(reference))
    return F.abs(value - reference) <= bound


def _judged(df: DataFrame, reference: str, absolute: float, relative: float) -> DataFrame:
    return df.withColumn("is_ready", within(F.col("value"), F.col(reference), absolute, relative))


def against_history(
    current: DataFrame, history: DataFrame, absolute: float = 0.0, relative: float = 0.0
) -> DataFrame:
    """Each new metric against the mean of its whole history."""
    mean = history.groupBy(*KEYS).agg(F.avg("value").alias("reference"))
    return _judged(current.join(mean, KEYS, "left"), "reference", absolute, relative)


def against_running(current: DataFrame, means: DataFrame, absolute: float = 0.0, relative: float = 0.0) -> DataFrame:
    """Each new metric against a running mean, as ``history_means`` keeps it: no history is read."""
    return _judged(current.join(means.select(*KEYS, "reference"), KEYS, "left"), "reference", absolute, relative)


def against_lookback(
    metrics: DataFrame, days: int = 3, absolute: float = 0.0, relative: float = 0.0
) -> DataFrame:
    """Each metric against its mean over the preceding calendar days; missing days stay missing."""
    number = F.unix_date("day")
    window = Window.partitionBy(*KEYS).orderBy(number).rangeBetween(-days, -1)
    return _judged(metrics.withColumn("reference", F.avg("value").over(window)), "reference", absolute, relative)


def against_month_end(metrics: DataFrame, absolute: float = 0.0, relative: float = 0.0) -> DataFrame:
    """Each metric against the same metric on the previous month's last day."""
    past = metrics.select(*KEYS, F.col("day").alias("month_end"), F.col("value").alias("reference"))
    keyed = metrics.withColumn("month_end", previous_month_end(F.col("day")))
    return _judged(keyed.join(past, [*KEYS, "month_end"], "left"), "reference", absolute, relative)
