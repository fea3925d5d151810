"""Publishing by switching: rows are written once, into the final layout, and made current by renaming partitions.

A load is staged below the output folder, in a folder that readers pass over. Once
it may be published, a marker is set; from then on every step can be done again: a staged
partition is renamed to its place, after the one that it replaces was set aside. A
driver that dies in between leaves either no marker (the load is dropped) or a
marker (the rest of its partitions is switched), which :func:`recover` settles. One writer at a time.
Renames are cheap where folders are real; on an object store they copy.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veriframe.sources.tables import NULL_PARTITION, write_partitioned

STAGING, MARKER, ASIDE = "_staging", "_PUBLISH", "_aside"
#: The register of loaded days: one column ``day``.
REGISTER = "_loaded_days"
#: Files of the register before they are merged.
REGISTER_FILES = 32


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    folder, files = _path(spark, path)
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory() and s.getPath().getName().startswith(prefix))


def stage(df: DataFrame, path: str, day: str) -> str:
    """Write a load into a staging folder of the output, partitioned by ``day``, and return the folder."""
    staged = f"{path.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
    df.hint("rebalance", day).write.partitionBy(day).parquet(staged)
    return staged


def staged_rows(spark: SparkSession, staged: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(staged)


def approve(spark: SparkSession, staged: str) -> None:
    """From here on the load is published, whatever happens to the driver."""
    marker, files = _path(spark, f"{staged}/{MARKER}")
    files.create(marker, True).close()


def drop(spark: SparkSession, staged: str) -> None:
    """Remove a staged load, and the folders around it if they hold nothing else."""
    folder, files = _path(spark, staged)
    files.delete(folder, True)
    for parent in (folder.getParent(), folder.getParent().getParent()):
        if files.exists(parent) and not files.listStatus(parent):
            files.delete(parent, False)


def switch(spark: SparkSession, staged: str) -> list[str]:
    """Put the partitions of an approved load in their places, enter its days in the register, and return their folders' names."""
    output = staged.rsplit(f"/{STAGING}/", 1)[0]
    names = [n for n in _folders(spark, staged) if "=" in n]
    # entered first: until a replay a day of the register may be missing from the table, never the reverse
    register_days(spark, output, map(_day, names))
    for name in names:
        source, files = _path(spark, f"{staged}/{name}")
        target, _ = _path(spark, f"{output}/{name}")
        if files.exists(target):
            aside, _ = _path(spark, f"{staged}/{ASIDE}/{name}")
            files.mkdirs(aside.getParent())
            if not files.rename(target, aside):
                raise OSError(f"could not set aside {target.toString()}")
        if not files.rename(source, target):
            raise OSError(f"could not publish {target.toString()}")
    drop(spark, staged)
    return names


def _day(folder: str) -> dt.date | None:
    value = folder.split("=", 1)[1]
    return None if value in NULL_PARTITION else dt.date.fromisoformat(value)


def recover(spark: SparkSession, path: str) -> None:
    """Finish approved loads and drop the others. Called before a load; a reader's view doesn't need it."""
    output = path.rstrip("/")
    for name in _folders(spark, f"{output}/{STAGING}"):
        staged = f"{output}/{STAGING}/{name}"
        marker, files = _path(spark, f"{staged}/{MARKER}")
        if files.exists(marker):
            switch(spark, staged)
        else:
            drop(spark, staged)


def register_days(spark: SparkSession, path: str, days: Iterable[dt.date | None]) -> None:
    """Enter days in the register of an output folder; a day that is there already changes nothing."""
    register = f"{path.rstrip('/')}/{REGISTER}"
    rows = [(d,) for d in days if d is not None]
    if not rows:
        return
    spark.createDataFrame(rows, "day date").coalesce(1).write.mode("append").parquet(register)
    folder, files = _path(spark, register)
    parts = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-")]
    if len(parts) > REGISTER_FILES:  # one row a day: merged before the parts go, so no day is ever missing
        spark.read.schema("day date").parquet(*[p.toString() for p in parts]).distinct().coalesce(1).write.mode("append").parquet(register)
        for part in parts:
            files.delete(part, False)


def loaded_days(spark: SparkSession, path: str) -> DataFrame:
    """The days in the register of an output folder."""
    return spark.read.schema("day date").parquet(f"{path.rstrip('/')}/{REGISTER}").distinct()


def write_registered(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite the partitions at hand and enter their days, the values of the first partition column, in the register.

    The write itself notes the days, at most one per calendar day.
    """
    seen = Observation()
    days = F.array_join(F.array_sort(F.collect_set(F.col(partition_by[0]).cast("string"))), " ")
    write_partitioned(df.observe(seen, days.alias("days")), path, partition_by)
    register_days(df.sparkSession, path, [dt.date.fromisoformat(d) for d in seen.get["days"].split()])
