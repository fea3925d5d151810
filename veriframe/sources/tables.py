"""Catalog tables: scans, listings, partitioned writes, set-up and tear-down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# How listings spell a null partition; the short form is also a text that a string column may hold.
NULL_PARTITION = ("__HIVE_DEFAULT_PARTITION__", "null")


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def rows_frame(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A small frame of expected rows with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def list_partitions(spark: SparkSession, table: str, column: str, data_type: str = "date") -> DataFrame:
    """Distinct values of one partition column, from the catalog: no file is read.

    Listed values are percent-encoded, and the null partition has a name of its own.
    """
    listing = spark.sql(f"SHOW PARTITIONS {table}")
    listed = F.str_to_map("partition", F.lit("/"), F.lit("="))[column]
    value = F.try_url_decode(F.replace(listed, F.lit("+"), F.lit("%2B")))
    nulls = NULL_PARTITION[:1] if data_type == "string" else NULL_PARTITION
    present = F.when(~value.isin(*nulls), value)
    return listing.select(present.cast(data_type).alias(column)).distinct()


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], replace_all: bool = False
) -> None:
    """Overwrite a partitioned Parquet folder.

    By default only the partitions present in ``df`` are replaced. The
    rebalance hint lets adaptive execution split a hot partition value over
    several files and merge small ones.
    """
    mode = "static" if replace_all else "dynamic"
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def save_partitioned_table(
    df: DataFrame, table: str, partition_by: Sequence[str], path: str | None = None
) -> None:
    """Replace a partitioned catalog table, schema included."""
    writer = (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .format("parquet")
        .partitionBy(*partition_by)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    """Drop a table. The files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")


def drop_database(spark: SparkSession, database: str) -> None:
    """Drop an empty database; one that still holds tables is refused."""
    spark.sql(f"DROP DATABASE IF EXISTS {database}")
