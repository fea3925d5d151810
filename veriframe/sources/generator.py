"""Synthetic partitioned source tables.

Row ids may come from ``spark.range`` or from any frame with a bigint ``id``;
every column is an expression over the id, so a retried task rebuilds the
same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the generated table.
WINDOW_DAYS = 4
MAX_ID = 10 ** 10 - 1
GOOD_PREFIX, GOOD_MIN_ID = "11", 10 ** 9
BAD_PREFIX, BAD_MIN_ID = "07", 10 ** 5
ANOMALY_TRANSACTIONS = 5


@dataclass(frozen=True)
class SourceSpec:
    """How the rows of one table variant are built."""

    prefix: str = GOOD_PREFIX
    min_id: int = GOOD_MIN_ID
    transactions: int = 1
    distinct_ids: int | None = None
    always_month_end: bool = False
    wide: bool = False


def success_spec(wide: bool = False) -> SourceSpec:
    return SourceSpec(wide=wide)


def audit_failure_spec() -> SourceSpec:
    """Ids with a wrong prefix and varying length."""
    return SourceSpec(prefix=BAD_PREFIX, min_id=BAD_MIN_ID, always_month_end=True)


def anomaly_failure_spec(data_size: int) -> SourceSpec:
    """Few distinct ids, so daily sums leave their history."""
    return SourceSpec(
        transactions=ANOMALY_TRANSACTIONS, distinct_ids=max(data_size // 10, 1), always_month_end=True
    )


def previous_month_end(load_date: dt.date) -> dt.date:
    return load_date.replace(day=1) - dt.timedelta(days=1)


def window_start(load_date: dt.date) -> dt.date:
    return load_date - dt.timedelta(days=WINDOW_DAYS - 1)


def needs_month_end(load_date: dt.date) -> bool:
    """The month-end slice is added only when that day lies outside the window."""
    return not window_start(load_date) <= previous_month_end(load_date) <= load_date


def prefixed_id(row_id: Column, prefix: str, low: int, high: int, distinct: int | None = None) -> Column:
    """Text id that counts up from ``low`` and wraps after ``high``."""
    position = row_id if distinct is None else row_id % F.lit(distinct)
    return F.concat(F.lit(prefix), (F.lit(low) + position % F.lit(high - low + 1)).cast("string"))


def cycling_day(row_id: Column, start: dt.date, days: int) -> Column:
    return F.date_add(F.lit(start), (row_id % F.lit(days)).cast("int"))


def mixed_hash(row_id: Column, seed: int = 0) -> Column:
    """Scatter an id over 0 .. 2^31-2 with plain bigint arithmetic.

    Two multiplicative rounds with a data-dependent factor between them. Any
    engine with 64-bit integers gets the same numbers.
    """
    prime = F.lit(2147483647).cast("bigint")
    # a seed other than zero is a multiplier of its own, so two seeds are no shifted copies of each other
    factor = 48271 if not seed else pow(48271, 2 * seed + 1, 2147483647)
    first = ((row_id + F.lit(1)) % prime) * F.lit(factor).cast("bigint") % prime
    return first * (first % F.lit(65521) + F.lit(1)) % prime


def weighted_value(row_id: Column, values: Sequence[str], weights: Sequence[int], seed: int = 0) -> Column:
    """One of ``values``, drawn in proportion to ``weights``."""
    draw = mixed_hash(row_id, seed) % F.lit(sum(weights))
    choice, upper = None, 0
    for value, weight in zip(values[:-1], weights[:-1]):
        upper += weight
        choice = (F if choice is None else choice).when(draw < upper, F.lit(value))
    return F.lit(values[-1]) if choice is None else choice.otherwise(F.lit(values[-1]))


def slice_rows(ids: DataFrame, spec: SourceSpec, start: dt.date, days: int) -> DataFrame:
    """Rows of one slice from a frame with a bigint ``id``."""
    row_id = F.col("id")
    columns = [prefixed_id(row_id, spec.prefix, spec.min_id, MAX_ID, spec.distinct_ids).alias("uc_id")]
    if spec.wide:
        columns += [
            prefixed_id(row_id, "", GOOD_MIN_ID, MAX_ID).alias("cust_key"),
            weighted_value(row_id, ["A", "B"], [4, 6]).alias("line_key"),
        ]
    columns += [
        F.lit(spec.transactions).alias("transactions"),
        cycling_day(row_id, start, days).alias("dl_data_dt"),
    ]
    return ids.select(*columns)


def source_table(
    spark: SparkSession, data_size: int, load_date: dt.date,
    spec: SourceSpec = SourceSpec(), partitions: int | None = None,
) -> DataFrame:
    """Four fifths of the rows over the window, one fifth on the previous month end."""
    main = spark.range(0, data_size * 4 // 5, 1, partitions)
    month_end = spark.range(0, data_size // 5, 1, partitions)
    return source_rows(main, month_end, load_date, spec)


def source_rows(
    main_ids: DataFrame, month_end_ids: DataFrame, load_date: dt.date, spec: SourceSpec = SourceSpec()
) -> DataFrame:
    """The same table from two id frames."""
    rows = slice_rows(main_ids, spec, window_start(load_date), WINDOW_DAYS)
    if spec.always_month_end or needs_month_end(load_date):
        rows = rows.unionByName(slice_rows(month_end_ids, spec, previous_month_end(load_date), 1))
    return rows


def metric_history_seed(
    spark: SparkSession, column: str, day: dt.date, table: str, dataset_date: int
) -> DataFrame:
    """Two history metrics of 1.0, the day before a run, for the anomaly gate."""
    # Metric names and the seeded value.
    return spark.createDataFrame(
        [("Column", column, name, 1.0, dataset_date, day.isoformat(), table) for name in ("Maximum", "Minimum")],
        "entity string, instance string, name string, value double, "
        "dataset_date bigint, date string, table_name string",
    )
