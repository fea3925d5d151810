"""Text logs and file listings."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.text import log_message, log_time

def read_log_lines(spark: SparkSession, glob: str) -> DataFrame:
    """Log lines as (time_value, message)."""
    return split_log_lines(spark.read.text(glob))


def split_log_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        log_time("value").alias("time_value"), log_message("value").alias("message")
    )


def list_files(
    spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False
) -> DataFrame | None:
    """Files below a path with size and time; ``None`` when the path is missing.

    Only the listing is read: the content column is pruned.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        return reader.load(path).select("path", "length", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def list_entries(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame | None:
    """Entries of a folder, files or folders of files: name, number of files, bytes."""
    files = list_files(spark, folder, pattern, recursive=True)
    if files is None:
        return None
    below = F.regexp_extract("path", f"{re.escape(folder.rstrip('/'))}/([^/]+)", 1)
    return files.groupBy(below.alias("name")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
