"""Any profile metrics of a stream, per day, from states that merge.

A batch is read once. Every row goes into one entry for each column, pair and
column set that the metrics are about, and one grouped aggregate turns the entries into
states: moments of a column, co-moments of a pair, and row counts of a
set's values. Moments merge around the merged mean; counts add up. Distinct metrics,
histograms, mutual information and exact quantiles are read off the merged counts
with the operators that profile a table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from veriframe.operators.profile import DISTINCT, QUANTILE, SCALAR, Metric, profile
from veriframe.operators.verdict import union_all
from veriframe.streaming.partials import fold_partials, read_partials, run_available, write_partials

STATE_SCHEMA = (
    "kind string, instance string, cells array<string>, n bigint, present bigint, low double, high double, "
    "total double, mean double, m2 double, mean_b double, m2_b double, c2 double, day date, batch_id bigint"
)
COLUMN, PAIR, COUNTS = "column", "pair", "counts"
_KEY = ["kind", "instance", "cells"]


def _is_counted(m: Metric) -> bool:
    return m.name in DISTINCT or m.name in ("Histogram", "MutualInformation") or m.name.startswith(QUANTILE)


def wanted_states(metrics: Sequence[Metric]) -> list[tuple[str, tuple[str, ...]]]:
    """``(kind, columns)`` of the states behind the metrics, each once."""
    out: dict[tuple[str, tuple[str, ...]], None] = {}
    for m in metrics:
        if m.name in SCALAR:
            out[COLUMN, m.columns] = None
        elif m.name == "Correlation":
            out[PAIR, m.columns] = None
        elif _is_counted(m):
            out[COUNTS, m.columns] = None
        else:
            raise ValueError(f"unknown metric {m.name}")
    return list(out)


def _text(df: DataFrame, column: str) -> Column:
    """A value as the text that counts it; both zeros are one."""
    kind = df.schema[column].dataType
    value = F.col(column) + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(column)
    return value.cast("string")


def batch_states(batch: DataFrame, metrics: Sequence[Metric], day: str) -> DataFrame:
    """The states of a batch, one row per day, state and, for counts, value. Entries carry the number of their state, its names come after."""
    number, texts = F.lit(None).cast("double"), F.lit(None).cast("array<string>")
    states, entries = wanted_states(metrics), []
    for k, (kind, columns) in enumerate(states):
        a = b = number
        cells = texts
        if kind == COLUMN and columns:
            a = F.col(columns[0]).cast("double")
        elif kind == PAIR:
            both = F.col(columns[0]).isNotNull() & F.col(columns[1]).isNotNull()
            a, b = (F.when(both, F.col(c)).cast("double") for c in columns)
        elif kind == COUNTS:
            cells = F.array(*[_text(batch, c) for c in columns])
        entries.append(F.struct(F.lit(k).alias("of"), cells.alias("cells"), a.alias("a"), b.alias("b")))
    rows = batch.select(F.col(day).alias("day"), F.inline(F.array(*entries)))
    n, names = F.count("a"), F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(Metric("", columns).instance).alias("instance")) for kind, columns in states])
    return rows.groupBy("day", "of", "cells").agg(
        F.count(F.lit(1)).alias("n"), n.alias("present"), F.min("a").alias("low"), F.max("a").alias("high"),
        F.sum("a").alias("total"), F.try_divide(F.sum("a"), n).alias("mean"), (F.var_pop("a") * n).alias("m2"),
        F.try_divide(F.sum("b"), n).alias("mean_b"), (F.var_pop("b") * n).alias("m2_b"), (F.covar_pop("a", "b") * n).alias("c2"),
    ).withColumn("name", names[F.col("of")]).select("name.*", "cells", "n", "present", "low", "high", "total", "mean", "m2", "mean_b", "m2_b", "c2", "day")


def merge_states(states: DataFrame) -> DataFrame:
    """One state per day, instance and value. The counts never meet the join that finds the merged means."""
    counts = states.where(F.col("kind") == COUNTS).groupBy("day", *_KEY).agg(F.sum("n").alias("n"))
    moments = states.where(F.col("kind") != COUNTS)
    weight = F.sum("present").cast("double")
    center = moments.groupBy(*[F.col(c).alias(f"of_{c}") for c in ("day", "kind", "instance")]).agg(
        F.try_divide(F.sum("total"), weight).alias("center_mean"), F.try_divide(F.sum(F.col("mean_b") * F.col("present")), weight).alias("center_mean_b"))
    same = F.col("day").eqNullSafe(F.col("of_day")) & (F.col("kind") == F.col("of_kind")) & (F.col("instance") == F.col("of_instance"))
    a, b = F.col("mean") - F.col("center_mean"), F.col("mean_b") - F.col("center_mean_b")
    merged = moments.join(center, same).groupBy("day", *_KEY).agg(
        F.sum("n").alias("n"), F.sum("present").alias("present"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"), F.max("center_mean").alias("mean"), F.sum(F.col("m2") + F.col("present") * a * a).alias("m2"),
        F.max("center_mean_b").alias("mean_b"), F.sum(F.col("m2_b") + F.col("present") * b * b).alias("m2_b"),
        F.sum(F.col("c2") + F.col("present") * a * b).alias("c2"))
    return merged.unionByName(counts, allowMissingColumns=True)


def _scalars(merged: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    n, present = F.col("n").cast("double"), F.col("present").cast("double")
    values = {
        "Size": n, "Completeness": present / n, "Mean": F.col("mean"), "Sum": F.col("total"),
        "StandardDeviation": F.sqrt(F.try_divide(F.col("m2"), present)), "Minimum": F.col("low"), "Maximum": F.col("high"),
        "Correlation": F.try_divide(F.col("c2"), F.sqrt(F.col("m2")) * F.sqrt(F.col("m2_b"))),
    }
    rows = F.array(*[
        F.struct(F.lit(PAIR if m.name == "Correlation" else COLUMN).alias("of_kind"), F.lit(m.entity).alias("entity"),
                 F.lit(m.instance).alias("of_instance"), F.lit(m.name).alias("name"), values[m.name].alias("value")) for m in metrics])
    return merged.where(F.col("kind") != COUNTS).select("day", "kind", "instance", F.inline(rows)).where(
        (F.col("kind") == F.col("of_kind")) & (F.col("instance") == F.col("of_instance"))).select("day", "entity", "instance", "name", "value")


def metrics_of(merged: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """``day, entity, instance, name, value``: all metrics from merged states."""
    plain = [m for m in metrics if not _is_counted(m)]
    frames = [_scalars(merged, plain)] if plain else []
    for columns in dict.fromkeys(m.columns for m in metrics if _is_counted(m)):
        of_set = merged.where((F.col("kind") == COUNTS) & (F.col("instance") == Metric("", columns).instance))
        rows = of_set.select("day", "n", *[F.col("cells")[k].alias(f"cell{k}") for k in range(len(columns))])
        named = {f"cell{k}": c for k, c in enumerate(columns)}
        texts = [Metric(m.name, tuple(named)) for m in metrics if m.columns == columns and _is_counted(m) and not m.name.startswith(QUANTILE)]
        numbers = [Metric(m.name, tuple(named)) for m in metrics if m.columns == columns and m.name.startswith(QUANTILE)]
        for frame, wanted in ((rows, texts), (rows.withColumn("cell0", F.col("cell0").try_cast("double")), numbers)):
            if wanted:
                found = profile(frame, wanted, ["day"], exact=True, weight="n")
                frames.append(found.select("day", "entity", F.lit(Metric("", columns).instance).alias("instance"), "name", "value"))
    return union_all(frames)


def store_states(batch: DataFrame, metrics: Sequence[Metric], day: str, path: str, batch_id: int) -> list[dt.date | None]:
    """Store a batch's states, merge those before it, and return the batch's days."""
    days = write_partials(batch_states(batch, metrics, day), path, "day", batch_id)
    fold_partials(batch.sparkSession, path, STATE_SCHEMA, "day", days, batch_id, merge_states)
    return days


def run_metrics(source: DataFrame, metrics: Sequence[Metric], day: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Profile a stream by all given metrics into states below ``folder``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        store_states(batch, metrics, day, f"{folder}/states", batch_id)

    return run_available(source, handle, checkpoint)


def read_metrics(spark: SparkSession, folder: str, metrics: Sequence[Metric], days: Iterable[dt.date | None] | None = None) -> DataFrame:
    """The metrics per day, of some days or of all; all must have been among those that the stream was run with, or need no other states."""
    return metrics_of(merge_states(read_partials(spark, f"{folder}/states", STATE_SCHEMA, "day", days)), metrics)
