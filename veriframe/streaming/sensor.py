"""Incremental sensor results.

Each batch updates the day metrics and judges again only the days whose
verdict can have changed: the batch's own days and, per rule, the later days
that look back on them. Rows without a day have no verdict.
"""

from __future__ import annotations

import datetime as dt
from calendar import monthrange
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veriframe.operators.anomaly import against_lookback, against_month_end
from veriframe.operators.logs import latest_rows
from veriframe.operators.sensors import SENSOR_KEYS, sensor_results
from veriframe.sources.tables import write_partitioned
from veriframe.streaming.partials import BATCH, on_days, run_available, shifted
from veriframe.streaming.profile import read_profile, store_states

RESULT_SCHEMA = (
    "parent_run_id string, upstrm_pl string, dt date, snsr_rule string, is_ready boolean, batch_id bigint"
)


def affected_days(
    touched: Iterable[dt.date], lookback: int
) -> tuple[set[dt.date], set[dt.date], set[dt.date]]:
    """Days to judge again by lookback and by month end, and all days that this reads."""
    near = set(shifted(touched, range(lookback + 1)))
    month = set(touched)
    for day in touched:
        first = day + dt.timedelta(days=1)
        if first.day == 1:
            month.update(first + dt.timedelta(days=n) for n in range(monthrange(first.year, first.month)[1]))
    ends = {day.replace(day=1) - dt.timedelta(days=1) for day in month}
    return near, month, set(shifted(near, range(-lookback, 1))) | month | ends


def judge(
    metrics: DataFrame, touched: Iterable[dt.date], run_id: str, pipeline: str, lookback: int, relative: float,
    month_end: bool = True,
) -> DataFrame:
    """Sensor rows of the lookback rule, and of the month end if asked, for the days that a batch affects."""
    near, month, _ = affected_days(touched, lookback)
    by_lookback = against_lookback(metrics, lookback, relative=relative).where(on_days("day", near))
    rows = sensor_results(by_lookback, run_id, f"{pipeline}_d{lookback}")
    if not month_end:
        return rows
    by_month = against_month_end(metrics, relative=relative).where(on_days("day", month))
    return rows.unionByName(sensor_results(by_month, run_id, f"{pipeline}_m1"))


def run_sensor(
    source: DataFrame, column: str, day: str, folder: str, checkpoint: str,
    run_id: str, pipeline: str, names: Sequence[str] = ("Minimum", "Maximum"),
    lookback: int = 3, relative: float = 0.5, month_end: bool = True,
) -> StreamingQuery:
    """Judge a stream's day metrics into ``folder/results``, by the days before and, unless left out, by the last month end."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        days = store_states(batch, column, day, f"{folder}/states", batch_id)
        touched = [d for d in days if d is not None]
        if not touched:
            return
        needed = affected_days(touched, lookback)[2]
        metrics = read_profile(spark, folder, needed).where(F.col("name").isin(*names))
        results = judge(metrics, touched, run_id, pipeline, lookback, relative, month_end)
        write_partitioned(
            results.withColumn(BATCH, F.lit(batch_id).cast("bigint")), f"{folder}/results", [BATCH]
        )

    return run_available(source, handle, checkpoint)


def read_sensor(spark: SparkSession, folder: str) -> DataFrame:
    """Newest verdict per pipeline, date and rule."""
    results = spark.read.schema(RESULT_SCHEMA).parquet(f"{folder}/results")
    return latest_rows(results, SENSOR_KEYS, [F.col(BATCH).desc()]).drop(BATCH)
