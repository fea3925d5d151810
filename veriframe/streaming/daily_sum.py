"""Incremental daily sums.

The output has the batch transform's columns plus an added value: the key's
sum of the day before plus the sum of the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veriframe.operators.transform import ADDED_COLUMN, DAY, KEY, LOADED, SUM_COLUMN, as_int
from veriframe.sources.publish import loaded_days, write_registered
from veriframe.streaming.partials import (
    fold_partials, on_days, read_partials, run_available, shifted, write_partials,
)

PARTIAL_SCHEMA = f"{KEY} string, part bigint, {DAY} date, batch_id bigint"
OUTPUT_SCHEMA = f"{KEY} string, {SUM_COLUMN} int, {ADDED_COLUMN} int, {LOADED} timestamp, {DAY} date"


def day_and_previous(daily: DataFrame) -> DataFrame:
    """Day sums with the added value, from rows (key, day, part).

    Each part counts for its own day and, as the previous value, for the day
    after; one grouped pass replaces a self join.
    """
    nothing = F.lit(None).cast("bigint")
    both = daily.select(
        KEY,
        F.inline(F.array(
            F.struct(F.col(DAY).alias(DAY), F.col("part").alias("own"), nothing.alias("before")),
            F.struct(
                F.date_add(DAY, 1).alias(DAY), nothing.alias("own"),
                F.when(F.col(DAY).isNotNull(), F.col("part")).alias("before"),
            ),
        )),
    )
    own, before = F.col("own"), F.coalesce("before", F.lit(0))
    return (
        both.groupBy(KEY, DAY).agg(F.sum("own").alias("own"), F.sum("before").alias("before"))
        .where(own.isNotNull())
        .select(KEY, as_int(own).alias(SUM_COLUMN), as_int(own + before).alias(ADDED_COLUMN), DAY)
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """One part per key and day."""
    return parts.groupBy(KEY, DAY).agg(F.sum("part").alias("part"))


def run_daily_sum(
    source: DataFrame, folder: str, checkpoint: str, loaded_at: Column | None = None
) -> StreamingQuery:
    """Sum a stream of (uc_id, transactions, dl_data_dt) into ``folder/output``.

    Only the days of a batch and their next days are rebuilt, from partials.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        partials = batch.groupBy(KEY, DAY).agg(F.sum("transactions").alias("part"))
        touched = write_partials(partials, f"{folder}/partials", DAY, batch_id)
        if not touched:
            return
        fold_partials(spark, f"{folder}/partials", PARTIAL_SCHEMA, DAY, touched, batch_id, merge_parts)
        affected = shifted(touched, (0, 1))
        needed = shifted(affected, (-1, 0))
        parts = read_partials(spark, f"{folder}/partials", PARTIAL_SCHEMA, DAY, needed)
        rebuilt = day_and_previous(parts).where(on_days(DAY, affected))
        stamped = rebuilt.withColumn(LOADED, F.current_timestamp() if loaded_at is None else loaded_at)
        write_registered(stamped, f"{folder}/output", [DAY])

    return run_available(source, handle, checkpoint)


def read_output(spark, folder: str) -> DataFrame:
    return spark.read.schema(OUTPUT_SCHEMA).parquet(f"{folder}/output").select(
        KEY, SUM_COLUMN, ADDED_COLUMN, DAY, LOADED
    )


def read_days(spark, folder: str) -> DataFrame:
    """The days of the output, from the register that the stream keeps: no file of the output is opened."""
    return loaded_days(spark, f"{folder}/output").withColumnRenamed("day", DAY)
