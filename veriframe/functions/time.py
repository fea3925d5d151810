"""Dates, epochs and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Marker for "no date given" and the default distance from today.
SKIP = "-skip"
DEFAULT_LAG_DAYS = 2

# Powers of ten as exact integers; pow() would go through double.
_POWERS = [10 ** n for n in range(0, 17)]


def epoch_to_timestamp(epoch: Column) -> Column:
    """Epoch of any digit count as a timestamp.

    Ten digits are seconds. Longer values carry a fraction, shorter ones are
    padded with zeros. Integer arithmetic keeps every microsecond.
    """
    value = epoch.cast("bigint")
    digits = F.length(value.cast("string"))
    powers = F.array(*[F.lit(p).cast("bigint") for p in _POWERS])
    up = value * F.try_element_at(powers, F.greatest(F.lit(17) - digits, F.lit(1)))
    power = F.try_element_at(powers, F.greatest(digits - F.lit(15), F.lit(1)))
    down = F.call_function("div", value - F.pmod(value, power), power)
    return F.timestamp_micros(F.when(digits <= 16, up).otherwise(down))


def seconds(milliseconds: Column) -> Column:
    return milliseconds / F.lit(1000.0)


def run_seconds(run_ms: Column, execution_ms: Column) -> Column:
    """Run duration, or the execution duration for single-task runs that have none."""
    return seconds(F.coalesce(run_ms, execution_ms))


def previous_month_end(day: Column) -> Column:
    return F.date_sub(F.trunc(day, "MM"), 1)


def day_text(day: Column) -> Column:
    """A day as ``yyyy-MM-dd``; a cast is much cheaper than formatting."""
    return day.cast("date").cast("string")


def resolve_load_date(start_text: Column, end_text: Column, given: Column, today: Column) -> Column:
    """The given load date, or today less the default lag when either input is the skip marker."""
    skipped = (start_text == SKIP) | (end_text == SKIP)
    return F.when(skipped, F.date_sub(today, DEFAULT_LAG_DAYS)).otherwise(given)


def day_range(spark: SparkSession, start: dt.date, end: dt.date, name: str = "day") -> DataFrame:
    """One row per day of the closed range; no rows when start is after end."""
    days = (end - start).days + 1
    return spark.range(max(days, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name)
    )
