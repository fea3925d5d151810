"""Checks that files and tables are there, or gone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.operators.verdict import status_of, verdict_columns
from veriframe.sources.files import list_entries, list_files
from veriframe.sources.tables import table_exists


def check_table_absent(spark: SparkSession, table: str) -> DataFrame:
    """The catalog has no such table."""
    found = table_exists(spark, table)
    return spark.range(1).select(
        *verdict_columns("table_absent", table, F.lit(int(found)), observed=F.lit("exists" if found else "absent"))
    )


def check_file_absent(spark: SparkSession, path: str) -> DataFrame:
    """The path is gone, as after a move to the archive. An empty folder still exists."""
    gone = list_files(spark, path) is None
    return spark.range(1).select(
        *verdict_columns("file_absent", path, F.lit(0 if gone else 1), observed=F.lit("gone" if gone else "exists"))
    )


def check_file_present(spark: SparkSession, folder: str, pattern: str | None = None, expected: int = 1) -> DataFrame:
    """A folder holds exactly the expected number of entries; a missing folder is an error."""
    entries = list_entries(spark, folder, pattern)
    if entries is None:
        return spark.range(1).select(
            *verdict_columns("file_present", folder, F.lit(1), observed=F.lit("missing path"),
                             expected=F.lit(expected), unanswerable=F.lit(True))
        )
    return entries.agg(F.count(F.lit(1)).alias("n")).select(
        *verdict_columns("file_present", folder, F.abs(F.col("n") - expected),
                         observed=F.col("n"), expected=F.lit(expected))
    )


def check_arrivals(entries: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected entries, one ``name`` per row, that a listing does or does not hold."""
    arrived = entries.select("name", F.lit(True).alias("_there"))
    missing = F.col("_there").isNull().cast("bigint")
    return expected.join(arrived, "name", "left").select(
        "name", (F.lit(1) - missing).alias("arrived"), status_of(missing).alias("status")
    )
