"""A running mean of metric history: rows and sum per instance and metric, extended by each run.

A run's own part is kept, so a run that comes again is taken out of the totals
before its new part goes in, and no append reads more than the totals and that one part.
Parts are written before the totals that hold them; totals count once they are complete, and a part
that is newer than them is what a writer left that died. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.sources.publish import _folders, _path

SCHEMA = "instance string, name string, n bigint, total double"
KEYS = ["instance", "name"]


def _committed(spark: SparkSession, path: str) -> int:
    numbers = [int(n.removeprefix("number=")) for n in _folders(spark, f"{path}/totals", "number=")]
    done = [n for n in numbers if _exists(spark, f"{path}/totals/number={n}/_SUCCESS")]
    return max(done, default=0)


def _exists(spark: SparkSession, path: str) -> bool:
    found, files = _path(spark, path)
    return files.exists(found)


def _remove(spark: SparkSession, path: str) -> None:
    found, files = _path(spark, path)
    files.delete(found, True)


def append_history(metrics: DataFrame, path: str, run: int) -> None:
    """Add the metrics (``instance, name, value``) of a numbered run, in the place of what it had before; nulls don't count."""
    spark, path = metrics.sparkSession, path.rstrip("/")
    known = _committed(spark, path)
    parts = [int(n.removeprefix("number=")) for n in _folders(spark, f"{path}/parts/run={run}", "number=")]
    for of in _folders(spark, f"{path}/parts", "run="):  # a part above the totals never went into them; at most one is there
        if _exists(spark, f"{path}/parts/{of}/number={known + 1}"):
            _remove(spark, f"{path}/parts/{of}/number={known + 1}")
    before = max([n for n in parts if n <= known], default=None)
    number = known + 1
    target = f"{path}/parts/run={run}/number={number}"
    metrics.groupBy(*KEYS).agg(F.count("value").alias("n"), F.sum(F.col("value").cast("double")).alias("total")).where("n > 0").write.mode("overwrite").parquet(target)
    changed = [(spark.read.schema(SCHEMA).parquet(target), 1)]
    if before is not None:
        changed.append((spark.read.schema(SCHEMA).parquet(f"{path}/parts/run={run}/number={before}"), -1))
    if known:
        changed.append((spark.read.schema(SCHEMA).parquet(f"{path}/totals/number={known}"), 1))
    signed = [df.select(*KEYS, (F.col("n") * sign).alias("n"), (F.col("total") * sign).alias("total")) for df, sign in changed]
    together = signed[0]
    for more in signed[1:]:
        together = together.unionByName(more)
    totals = together.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where("n > 0")
    totals.write.mode("overwrite").parquet(f"{path}/totals/number={number}")
    if before is not None:
        _remove(spark, f"{path}/parts/run={run}/number={before}")
    for name in _folders(spark, f"{path}/totals", "number="):
        if int(name.removeprefix("number=")) < known:
            _remove(spark, f"{path}/totals/{name}")


def history_means(spark: SparkSession, path: str) -> DataFrame:
    """``instance, name, n, reference``: the mean of the history so far."""
    known = _committed(spark, path.rstrip("/"))
    totals = spark.read.schema(SCHEMA).parquet(f"{path.rstrip('/')}/totals/number={known}") if known else spark.createDataFrame([], SCHEMA)
    return totals.select(*KEYS, "n", (F.col("total") / F.col("n")).alias("reference"))
