"""Per-batch partial results, the state that all streams here share.

Each micro-batch writes its own partials into partitions named after the day
and the batch. A replayed batch overwrites exactly those partitions, so a
retry after a lost executor or driver cannot count anything twice, and a day
that arrives over several batches is the merge of its partials. The source is
never read again.

Partition ``-n`` of a day holds the merge of all its batches before ``n``. A batch
merges the earlier ones of its days and then leaves them be; the next batch of a day
removes what is merged. So a day has a handful of partitions however many batches
feed it, and the last batch can be replayed at any point. A folder belongs to one
checkpoint.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from veriframe.sources.tables import NULL_PARTITION, write_partitioned

BATCH = "batch_id"


def read_stream(spark: SparkSession, folder: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Written as a glob because a stream's plain path has to be a folder.
    return reader.parquet(f"{folder}/{table}.parque[t]")


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that has arrived, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_partials(partials: DataFrame, path: str, day: str, batch_id: int) -> list[dt.date | None]:
    """Store a batch's partials, replacing those of an earlier attempt, and return their days.

    The write itself notes the days, at most one per calendar day and ``None`` for
    rows without one, so a batch is read once.
    """
    seen = Observation()
    noted = partials.observe(
        seen, F.array_join(F.array_sort(F.collect_set(F.col(day).cast("string"))), " ").alias("days"),
        F.max(F.col(day).isNull()).alias("undated"),
    )
    write_partitioned(noted.withColumn(BATCH, F.lit(batch_id).cast("bigint")), path, [day, BATCH])
    return [dt.date.fromisoformat(d) for d in seen.get["days"].split()] + [None] * bool(seen.get["undated"])


def _stored(spark: SparkSession, path: str, day: str, days: Iterable[dt.date | None] | None = None) -> dict[str, set[int]]:
    """The batch numbers of each day's folder, of some days or of all."""
    names = "*" if days is None else f"{{{','.join(NULL_PARTITION[0] if d is None else d.isoformat() for d in days)}}}"
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{day}={names}/{BATCH}=*")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, set[int]] = {}
    for status in files.globStatus(pattern) or []:
        folder = status.getPath()
        found.setdefault(folder.getParent().getName(), set()).add(int(folder.getName().removeprefix(f"{BATCH}=")))
    return found


def current(numbers: Iterable[int]) -> list[int]:
    """Of a day's batch numbers the newest merge and the batches that it does not hold."""
    newest = min([0, *numbers])
    return [newest] * (newest < 0) + sorted(n for n in numbers if n >= -newest)


def _read(spark: SparkSession, path: str, schema: StructType | str, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def fold_partials(
    spark: SparkSession, path: str, schema: StructType | str, day: str,
    days: Iterable[dt.date | None], batch_id: int, merge: Callable[[DataFrame], DataFrame],
) -> None:
    """Merge what the days had before this batch, and remove what earlier merges hold."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    several = []
    for name, numbers in _stored(spark, path, day, days).items():
        earlier = {n for n in numbers if n < batch_id}
        kept = current(earlier)
        for n in earlier - set(kept):
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/{BATCH}={n}")
            folder.getFileSystem(conf).delete(folder, True)
        if len(kept) > 1:
            several += [f"{path}/{name}/{BATCH}={n}" for n in kept]
    if several:
        merged = merge(_read(spark, path, schema, several))
        write_partitioned(merged.withColumn(BATCH, F.lit(-batch_id).cast("bigint")), path, [day, BATCH])


def read_partials(
    spark: SparkSession, path: str, schema: StructType | str, day: str,
    days: Iterable[dt.date | None] | None = None,
) -> DataFrame:
    """Partials of some days, or of all, each batch once. Only the folders of the given days are listed."""
    stored = _stored(spark, path, day, days)
    return _read(spark, path, schema, [f"{path}/{name}/{BATCH}={n}" for name, of in stored.items() for n in current(of)])


def on_days(column: str, days: Iterable[dt.date | None]) -> Column:
    """Rows of the given days; ``None`` stands for rows without a day."""
    days = list(days)
    known = F.col(column).isin(*[d for d in days if d is not None])
    return known | F.col(column).isNull() if None in days else known


def shifted(days: Iterable[dt.date | None], offsets: Iterable[int]) -> list[dt.date | None]:
    """All given days moved by all given offsets, as far as the calendar goes; no day stays no day."""
    days, moves = list(days), list(offsets)
    first, last = dt.date.min.toordinal(), dt.date.max.toordinal()
    known = {d.toordinal() + n for d in days if d is not None for n in moves}
    return [dt.date.fromordinal(n) for n in sorted(known) if first <= n <= last] + [None] * (None in days)
