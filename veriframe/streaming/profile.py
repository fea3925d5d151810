"""Incremental day metrics of a numeric column.

A batch stores mergeable states per day; metrics are read off the merged
states. Squared deviations are merged around the merged mean, which stays
accurate when the mean is large against the spread.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veriframe.streaming.partials import fold_partials, read_partials, run_available, write_partials

STATE_SCHEMA = (
    "instance string, n bigint, present bigint, total double, low double, high double, "
    "mean double, m2 double, day date, batch_id bigint"
)


def day_states(batch: DataFrame, column: str, day: str) -> DataFrame:
    """Mergeable state of one column per day."""
    value = F.col(column).cast("double")
    return batch.groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("present"),
        F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("m2"),
    ).select(
        F.lit(column).alias("instance"), "n", "present", "total", "low", "high", "mean", "m2", "day"
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per day and instance."""
    keys = ["day", "instance"]
    center = states.groupBy(F.col("day").alias("_day"), F.col("instance").alias("_instance")).agg(
        F.try_divide(F.sum("total"), F.sum("present").cast("double")).alias("center")
    )
    # Null-safe, so that rows without a day keep their metrics.
    same = F.col("day").eqNullSafe(F.col("_day")) & (F.col("instance") == F.col("_instance"))
    offset = F.col("mean") - F.col("center")
    return states.join(center, same).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("present").alias("present"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("center").alias("mean"),
        F.sum(F.col("m2") + F.col("present") * offset * offset).alias("m2"),
    )


def state_metrics(merged: DataFrame) -> DataFrame:
    """Merged states as long metric rows."""
    present = F.col("present").cast("double")
    values = {
        "Size": F.col("n").cast("double"),
        "Completeness": present / F.col("n"),
        "Mean": F.col("mean"),
        "Sum": F.col("total"),
        "StandardDeviation": F.sqrt(F.try_divide(F.col("m2"), present)),
        "Minimum": F.col("low"),
        "Maximum": F.col("high"),
    }
    rows = [F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in values.items()]
    return merged.select("day", "instance", F.inline(F.array(*rows)))


def store_states(batch: DataFrame, column: str, day: str, path: str, batch_id: int) -> list[dt.date | None]:
    """Store a batch's states, merge those before it, and return the batch's days."""
    days = write_partials(day_states(batch, column, day), path, "day", batch_id)
    fold_partials(batch.sparkSession, path, STATE_SCHEMA, "day", days, batch_id, merge_states)
    return days


def run_profile(source: DataFrame, column: str, day: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Profile a stream into states below ``folder``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        store_states(batch, column, day, f"{folder}/states", batch_id)

    return run_available(source, handle, checkpoint)


def read_profile(
    spark: SparkSession, folder: str, days: Iterable[dt.date | None] | None = None
) -> DataFrame:
    """Metrics per day, of some days or of all: day, instance, name, value."""
    states = read_partials(spark, f"{folder}/states", STATE_SCHEMA, "day", days)
    return state_metrics(merge_states(states))
