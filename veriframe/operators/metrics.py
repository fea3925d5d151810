"""Checks on metric repositories in their long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.functions.text import text_list
from veriframe.operators.sets import SUPERSET, check_sets
from veriframe.operators.verdict import ERROR, FAIL, PASS, verdict_columns
from veriframe.sources.workspace import written


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics of each data date, from its newest run only."""
    newest = metrics.groupBy("date").agg(F.max("dataset_date").alias("dataset_date"))
    return metrics.join(newest, ["date", "dataset_date"], "left_semi")


def check_profile_metrics(
    metrics: DataFrame, expected: Mapping[str, Sequence[str]], data_date: str | None = None
) -> DataFrame:
    """Metric names of the newest run equal an expected set, per data date and instance.

    ``expected`` maps an instance to its names; an empty set is allowed. With a
    data date only that date is judged, whether or not it has metrics. The names
    are written once, so the repository is read once.
    """
    asked = F.col("instance").isin(*expected)
    if data_date is not None:
        metrics = metrics.where(F.col("date") == data_date)
    metrics = written(metrics.select(
        "date", "dataset_date", *[F.when(asked, F.col(c)).alias(c) for c in ("instance", "name")]).distinct(), "names")
    if data_date is None:
        dates = metrics.select("date").distinct()
    else:
        dates = metrics.sparkSession.range(1).select(F.lit(data_date).alias("date"))
    # A null name on both sides keeps instances without any name in the result.
    sets = [
        F.struct(F.lit(i).alias("instance"), F.array(F.lit(None), *[F.lit(n) for n in names]).alias("names"))
        for i, names in expected.items()
    ]
    grid = dates.select("date", F.inline(F.array(*sets)))
    wanted = grid.select("date", "instance", F.explode("names").alias("name"))
    found = latest_metrics(metrics).where(F.col("instance").isin(*expected)).select("date", "instance", "name")
    nothing = grid.select("date", "instance", F.lit(None).cast("string").alias("name"))
    return check_sets(found.unionByName(nothing), wanted, "name", ["date", "instance"])


def check_repository(metrics: DataFrame) -> DataFrame:
    """A repository without any metric is an error."""
    return metrics.limit(1).agg(F.count(F.lit(1)).alias("n")).select(
        *verdict_columns("repository", "*", F.lit(0), observed=F.col("n"), unanswerable=F.col("n") == 0)
    )


def check_metric_dates(metrics: DataFrame, expected: DataFrame, column: str = "date") -> DataFrame:
    """Every expected value occurs in a tag column."""
    return check_sets(metrics.select(column), expected, column, mode=SUPERSET)


def check_metric_date_list(metrics: DataFrame, expected: Sequence[str], column: str = "dt_list") -> DataFrame:
    """A list held as text equals the expected set, in every record.

    Records with the same text are judged once. Text that is not a list is an error.
    """
    values = F.col("_list")
    wanted = F.array(*[F.lit(v) for v in expected]).cast("array<string>")
    missing, unexpected = F.array_except(wanted, values), F.array_except(values, wanted)
    return (
        metrics.groupBy(column).agg(F.count(F.lit(1)).alias("records"))
        .withColumn("_list", text_list(column))
        .select(
            column, "records",
            F.size(missing).cast("bigint").alias("missing"),
            F.size(unexpected).cast("bigint").alias("unexpected"),
            F.when(values.isNull(), ERROR)
            .when((F.size(missing) == 0) & (F.size(unexpected) == 0), PASS)
            .otherwise(FAIL).alias("status"),
        )
    )
